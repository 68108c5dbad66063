"""Byte-level BPE by recursive queries, one DuckDB connection per task.

Spark deals out the documents; a task cuts its texts by the pattern and encodes each
distinct piece once. Token positions of the pieces are rows; a recursive query joins
neighbours with the merge table, contracts each piece's leftmost pair of least rank and
stops at the fixpoint. An ordered aggregation turns ids back into bytes.

The merge table holds every two tokens whose bytes together are a token. Pieces of
``LONG`` bytes and more contract all places of their least pair in a step; this is done
only for pairs after which no lower rank can appear, so the result is the same.

Pieces are remembered per worker process, ``REMEMBERED`` at most before a fresh start.
A null or empty text has no tokens and decodes to nothing. Very long texts are cut piece by
piece. Null ids, repeated rows and extra columns do no harm; only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm.common import give_back, keep_only

REMEMBERED = 300_000
QUERY_PIECES = 20_000
QUERY_BYTES = 1 << 18
HISTORY_ROWS = 3_000_000
LONG = 128
SLICE_CHARS = 1 << 21

# Both recursions return the last state of every piece; ``step`` counts contractions.
_LAST = """
SELECT piece, pos, tok, step FROM state
JOIN (SELECT piece, max(step) AS step FROM state GROUP BY piece) USING (piece, step)
ORDER BY piece, pos
"""

_PAIRS = """
    SELECT a.spot >> 32 AS piece, a.spot & 4294967295 AS pos, p.merged, p.alone
    FROM (SELECT (piece::BIGINT << 32) | pos AS spot, tok FROM state WHERE step < $steps) a
    JOIN (SELECT ((piece::BIGINT << 32) | pos) - 1 AS spot, tok FROM state) b ON b.spot = a.spot
    JOIN merges p ON p.pair = (a.tok::BIGINT << 32) | b.tok
"""

_SHORT = f"""
WITH RECURSIVE state(piece, step, pos, tok) AS (
  SELECT piece, 0, pos, tok FROM seed
  UNION ALL
  (WITH best AS (
     SELECT piece, min((merged::BIGINT << 32) | pos) AS least FROM ({_PAIRS}) GROUP BY piece)
   SELECT s.piece, s.step + 1, (s.pos - (s.pos > (least & 4294967295))::INT)::INT,
          CASE WHEN s.pos = (least & 4294967295) THEN (least >> 32)::INT ELSE s.tok END
   FROM state s JOIN best ON s.piece = best.piece WHERE s.pos <> (least & 4294967295) + 1)
)
{_LAST}
"""

_LONG = f"""
WITH RECURSIVE state(piece, step, pos, tok) AS (
  SELECT piece, 0, pos, tok FROM seed
  UNION ALL
  (WITH pairs AS MATERIALIZED ({_PAIRS}),
   least AS (
     SELECT piece, pos, merged, alone, row_number() OVER (PARTITION BY piece ORDER BY pos) AS n
     FROM (SELECT *, min(merged) OVER (PARTITION BY piece) AS low FROM pairs) WHERE merged = low),
   taken AS (
     SELECT piece, pos, merged FROM (
       SELECT *, row_number() OVER (PARTITION BY piece, pos - n ORDER BY pos) AS nth FROM least)
     WHERE CASE WHEN alone THEN n = 1 ELSE nth % 2 = 1 END),
   marked AS (
     SELECT s.piece, s.step, s.pos, s.tok, t.merged,
            count(t.pos) OVER (PARTITION BY s.piece ORDER BY s.pos) AS upto,
            lag(t.pos) OVER (PARTITION BY s.piece ORDER BY s.pos) AS before
     FROM state s LEFT JOIN taken t ON t.piece = s.piece AND t.pos = s.pos
     WHERE s.piece IN (SELECT piece FROM taken))
   SELECT piece, step + 1, (pos - upto + (merged IS NOT NULL)::INT)::INT, coalesce(merged, tok)
   FROM marked WHERE before IS NULL)
)
{_LAST}
"""

_DECODE = "SELECT string_agg(hex(v.bytes), '' ORDER BY i.place) FROM ids i JOIN vocabulary v ON v.tok = i.tok"


def load_ranks(path: str) -> bytes:
    """The rank file as it is: a token in base64 and its rank on each line."""
    with open(path, "rb") as file:
        return file.read()


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Parts of ``pool``, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return pool[:0]
    return pool[np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)]


class Codec:
    """Encodes and decodes pieces; remembers them."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.find = regex.compile(pattern)
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.single = np.zeros(256, np.int32)
        for token, rank in self.ranks.items():
            if len(token) == 1:
                self.single[token[0]] = rank
        rows = [(left, right, rank) for token, rank in self.ranks.items() for cut in range(1, len(token))
                if (left := self.ranks.get(token[:cut])) is not None
                and (right := self.ranks.get(token[cut:])) is not None]
        left, right, merged = np.array(rows, np.int64).reshape(-1, 3).T
        # Tokens that can still be part of a pair of lower rank are contracted alone.
        risky = np.union1d(left[merged < left], right[merged < right])
        merges = pa.table({"pair": left << 32 | right, "merged": merged.astype(np.int32),
                           "alone": np.isin(merged, risky)})
        self.width = np.zeros(max(self.ranks.values(), default=0) + 1, np.int64)
        self.width[list(self.ranks.values())] = [len(token) for token in self.ranks]
        vocabulary = pa.table({"tok": pa.array(list(self.ranks.values()), pa.int32()),
                               "bytes": pa.array(list(self.ranks), pa.binary())})
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        none = np.empty(0, np.int64)
        self.ids, self.id_at, self.id_count = np.empty(0, np.int32), none, none
        self.bytes, self.byte_at, self.byte_count = np.empty(0, np.uint8), none, none

    def contract(self, pieces: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """Piece and id of every token at the fixpoint, in order within a piece."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        pos = np.arange(len(piece), dtype=np.int32) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        seed = pa.table({"piece": piece, "pos": pos.astype(np.int32),
                         "tok": self.single[np.frombuffer(b"".join(pieces), np.uint8)]})
        found = []
        while seed.num_rows:
            # All states of a recursion stay in memory, so a query makes a bounded number of steps.
            steps = max(1, HISTORY_ROWS // seed.num_rows)
            self.db.register("seed", seed)
            state = self.db.sql(query, params={"steps": steps}).to_arrow_table()
            self.db.unregister("seed")
            ended = state.column("step").to_numpy() < steps
            found.append((state.column("piece").to_numpy()[ended], state.column("tok").to_numpy()[ended]))
            seed = state.select(["piece", "pos", "tok"]).filter(pa.array(~ended))
        return (np.concatenate([f[0] for f in found]) if found else piece,
                np.concatenate([f[1] for f in found]) if found else piece)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for, by an ordered aggregation."""
        self.db.register("ids", pa.table({"place": np.arange(len(ids)), "tok": ids}))
        text = self.db.execute(_DECODE).fetchall()[0][0]
        self.db.unregister("ids")
        return bytes.fromhex(text or "")

    def _groups(self, pieces: list[str]) -> Iterator[tuple[list[str], str]]:
        group, size = [], 0
        for piece in sorted(pieces, key=len):
            long = len(piece) * 4 >= LONG
            size += len(piece)
            group.append(piece)
            if long or len(group) >= QUERY_PIECES or size >= QUERY_BYTES:
                yield group, _LONG if long else _SHORT
                group, size = [], 0
        if group:
            yield group, _SHORT

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces not yet known."""
        new = [p for p in pieces if p not in self.known]
        for group, query in self._groups(new):
            raw = [p.encode() for p in group]
            whole = [self.ranks.get(r, -1) for r in raw]
            open_ = np.array([n for n, rank in enumerate(whole) if rank < 0], np.int64)
            piece, tok = self.contract([raw[n] for n in open_], query)
            ready = np.array([n for n, rank in enumerate(whole) if rank >= 0], np.int64)
            piece = np.concatenate([open_[piece], ready])
            tok = np.concatenate([tok, np.array(whole, np.int32)[ready]]).astype(np.int32)
            order = np.argsort(piece, kind="stable")
            piece, tok = piece[order], tok[order]
            counts = np.bincount(piece, minlength=len(group))
            widths = np.bincount(piece, self.width[tok], len(group)).astype(np.int64)
            self.id_at = np.concatenate([self.id_at, len(self.ids) + np.cumsum(counts) - counts])
            self.byte_at = np.concatenate([self.byte_at, len(self.bytes) + np.cumsum(widths) - widths])
            self.id_count = np.concatenate([self.id_count, counts])
            self.byte_count = np.concatenate([self.byte_count, widths])
            self.ids = np.concatenate([self.ids, tok])
            self.bytes = np.concatenate([self.bytes, np.frombuffer(self.decode(tok), np.uint8)])
            self.known.update(zip(group, range(len(self.known), len(self.known) + len(group)), strict=True))

    def cut(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, a bounded list at a time."""
        if len(text) <= SLICE_CHARS:
            yield self.find.findall(text)
            return
        found = (match.group() for match in self.find.finditer(text))
        while part := list(islice(found, SLICE_CHARS // 8)):
            yield part

    def run(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and decoded bytes of each text."""
        out_ids: list[list[np.ndarray]] = [[] for _ in texts]
        out_bytes: list[list[np.ndarray]] = [[] for _ in texts]

        def flush(held: list[tuple[int, list[str]]]) -> None:
            if len(self.known) > REMEMBERED:
                self.forget()
            self.learn({piece for _, part in held for piece in part})
            for n, part in held:
                at = np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))
                out_ids[n].append(_gather(self.ids, self.id_at[at], self.id_count[at]))
                out_bytes[n].append(_gather(self.bytes, self.byte_at[at], self.byte_count[at]))

        held, size = [], 0
        for n, text in enumerate(texts):
            for part in self.cut(text):
                held.append((n, part))
                size += sum(map(len, part)) if len(text) > SLICE_CHARS else len(text)
                if size >= SLICE_CHARS:
                    flush(held)
                    held, size = [], 0
        flush(held)
        return ([np.concatenate(p) if p else np.empty(0, np.int32) for p in out_ids],
                [np.concatenate(p) if p else np.empty(0, np.uint8) for p in out_bytes])


def codec(ranks: bytes, pattern: str) -> Codec:
    """One codec for each worker process, until it runs something else."""
    return keep_only((ranks, pattern), lambda: Codec(ranks, pattern))


def _offsets(parts: list[np.ndarray]) -> pa.Buffer:
    return pa.py_buffer(np.cumsum([0, *map(len, parts)], dtype=np.int32))


def encode_decode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: token ids of each whole text, and the bytes that they stand for."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for part in parts:
            start = 0
            lengths = np.cumsum(np.diff(np.frombuffer(part.column(1).buffers()[1], np.int32)[
                part.column(1).offset:part.column(1).offset + len(part) + 1])) if len(part) else []
            while start < len(part):
                end = int(np.searchsorted(lengths, (lengths[start - 1] if start else 0) + 2 * SLICE_CHARS)) + 1
                rows = part.slice(start, end - start)
                ids, decoded = own.run([text or "" for text in rows.column(1).to_pylist()])
                values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    rows.column(0),
                    pa.Array.from_buffers(pa.list_(pa.int32()), len(ids), [None, _offsets(ids)], children=[values]),
                    pa.Array.from_buffers(pa.binary(), len(decoded), [
                        None, _offsets(decoded), pa.py_buffer(np.concatenate(decoded))])],
                    ["doc_id", "ids", "decoded"])
                start = end
                # Workers are kept between tasks; what this batch held goes back to the system.
                del rows, ids, decoded, values
                give_back()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(batches, "doc_id long, ids array<int>, decoded binary")
