"""Likelihood of texts over all their cuts into subwords.

The pieces and their scores come from an existing vocabulary; it is not trained here. A
word (lower-cased, with a blank before it) is a lattice of pieces. Its probability is the
sum over every path, by a forward recursion in log space. The weights start from the
vocabulary's scores; one forward-backward pass over all training words replaces them by
expected counts, smoothed with the start. A word that occurs in training takes its share
of the training words; what Witten and Bell leave for others (distinct words over all and
distinct ones) is spread by the lattice over every word. A text is its words and one end.

Beside it stands a word model with added tenths: log10((c + 0.1) / (N + 0.1 (V + 1))) of
each word and the end.

Blocks of documents send each slice of the words' hash range their distinct words and
how often they occur in training; slices add up, weigh the lattices once for each
distinct word, and answer. A null or blank text is its end alone. Rows without
``doc_id`` are scored but not learned from and not held out. Repeated rows count each.
Words of any length are taken whole; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm import words
from mapsheaf.llm.blocks import (
    ANSWER, QUESTION, each_answered, each_block, expand, pack, questions, slice_of, slices_for, squeeze, unpack,
)
from mapsheaf.llm.common import materialize

BLOCK_BYTES = 8 << 20
SLICE_WORDS = 1 << 17
BATCH_CELLS = 1 << 20
PRIOR = 10_000.0  # the start's weight against the expected counts
_FILTER_BITS = 22


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes and their start log-probabilities, from a sentencepiece file.

    Scores of a merge vocabulary are negative ranks; rank r weighs 1 / (r + 1). Byte
    pieces weigh as the last rank, so every text has a path.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    size = model.get_piece_size()
    for n in range(size):
        if model.is_control(n) or model.is_unknown(n) or model.is_unused(n):
            continue
        text = model.id_to_piece(n)
        piece = bytes([int(text[3:5], 16)]) if model.is_byte(n) else text.replace("▁", " ").encode()
        share = 1 / size if model.is_byte(n) else 1 / (1 - min(0.0, model.get_score(n)))
        weight[piece] = weight.get(piece, 0.0) + share
    for byte in range(256):
        weight.setdefault(bytes([byte]), 1 / size)
    pieces = sorted(weight)
    start = np.log([weight[p] for p in pieces])
    return pieces, start - np.logaddexp.reduce(start)


def _sum_exp(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - safe[:, None]).sum(axis=1)) + safe


class Lattice:
    """Lattices of words over the pieces, many words of one length at a time."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray) -> None:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        found = words.hashes(data, ends - [len(p) for p in pieces], ends)
        self.order = np.argsort(found)
        self.hashes = found[self.order]
        self.longest = max(map(len, pieces))
        self.weights = np.append(weights, -np.inf)  # the last one: no piece
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of pieces; one past the last for what is none."""
        out = np.full(hashes.shape, len(self.order), np.int32)
        maybe = self.filter[hashes >> np.uint64(64 - _FILTER_BITS)]
        some = hashes[maybe]
        at = np.minimum(np.searchsorted(self.hashes, some), len(self.order) - 1)
        out[maybe] = np.where(self.hashes[at] == some, self.order[at], len(self.order))
        return out

    def batches(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and piece numbers by row, start and length, for texts of one length."""
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(lengths, kind="stable")
        first = 0
        while first < len(order):
            size = int(lengths[order[first]])
            most = max(1, BATCH_CELLS // (size * min(size, self.longest)))
            last = min(int(np.searchsorted(lengths[order], size, "right")), first + most)
            rows = order[first:last]
            data = np.frombuffer(b"".join([texts[n] for n in rows]), np.uint8)
            wide = min(size, self.longest)
            ids = np.full((len(rows), size, wide), len(self.order), np.int32)
            for length in range(1, wide + 1):
                starts = (np.arange(len(rows))[:, None] * size + np.arange(size - length + 1)).ravel()
                found = self.lookup(words.hashes(data, starts, starts + length))
                ids[:, :size - length + 1, length - 1] = found.reshape(len(rows), -1)
            yield rows, ids
            first = last

    def forward(self, ids: np.ndarray) -> np.ndarray:
        """Log-probability of each prefix, summed over its cuts."""
        count, size, wide = ids.shape
        out = np.full((count, size + 1), -np.inf)
        out[:, 0] = 0
        for end in range(1, size + 1):
            lengths = np.arange(1, min(wide, end) + 1)
            out[:, end] = _sum_exp(out[:, end - lengths] + self.weights[ids[:, end - lengths, lengths - 1]])
        return out

    def backward(self, ids: np.ndarray) -> np.ndarray:
        count, size, wide = ids.shape
        out = np.full((count, size + 1), -np.inf)
        out[:, size] = 0
        for start in range(size - 1, -1, -1):
            reach = min(wide, size - start)
            out[:, start] = _sum_exp(
                out[:, start + 1:start + 1 + reach] + self.weights[ids[:, start, :reach]])
        return out

    def log_probability(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for rows, ids in self.batches(texts):
            out[rows] = self.forward(ids)[:, -1]
        return out

    def expected(self, texts: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all cuts of the texts."""
        total = np.zeros(len(self.order) + 1)
        for rows, ids in self.batches(texts):
            ahead, back = self.forward(ids), self.backward(ids)
            size, wide = ids.shape[1:]
            for length in range(1, wide + 1):
                part = ids[:, :size - length + 1, length - 1]
                share = np.exp(ahead[:, :size - length + 1] + self.weights[part] + back[:, length:] - ahead[:, -1:])
                total += np.bincount(part.ravel(), (share * counts[rows, None]).ravel(), len(total))
        return total[:-1]


class _Words:
    """The distinct words of a block, sorted by slice."""

    def __init__(self, payload: bytes, folds: int, slices: int) -> None:
        self.ids, texts = unpack(payload)
        data, starts, ends, self.doc = words.split([t.lower() for t in texts])
        found = words.hashes(data, starts, ends)
        key, first, self.which = np.unique(found, return_index=True, return_inverse=True)
        self.slice = slice_of(key, slices)
        raw = data.tobytes()
        self.words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        self.fold = np.array([_fold(n, folds) for n in self.ids])


def _fold(number: int | None, folds: int) -> int:
    from zlib import crc32

    return -1 if number is None else crc32(str(number).encode()) % folds


def _ask(block: int, payload: bytes, folds: int, held_out: int, slices: int) -> pd.DataFrame:
    own = _Words(payload, folds, slices)
    learned = (own.fold >= 0) & (own.fold != held_out)
    counts = np.bincount(own.which, learned[own.doc], len(own.words)).astype(np.uint32)

    def write(part: slice) -> bytes:
        text = squeeze(b" ".join(own.words[part]))
        return len(text).to_bytes(4, "little") + text + squeeze(counts[part])

    out = questions(block, own.slice, write)
    # The ends of the training texts, as a question of their own to slice -1.
    ends = pd.DataFrame({"slice": np.int32([-1]), "block": np.int64([block]),
                         "question": [int(learned.sum()).to_bytes(8, "big")]})
    return pd.concat([out, ends])


def _read(part: bytes) -> tuple[list[bytes], np.ndarray]:
    size = int.from_bytes(part[:4], "little")
    return expand(part[4:4 + size]).split(b" "), expand(part[4 + size:], "u4")


def _added_up(parts: list[tuple[list[bytes], np.ndarray]]) -> dict[bytes, int]:
    total: dict[bytes, int] = {}
    for names, counts in parts:
        for name, count in zip(names, counts.tolist(), strict=True):
            total[name] = total.get(name, 0) + count
    return total


def score(docs: DataFrame, pieces: list[bytes], start: np.ndarray, folds: int = 10, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row."""
    blocks = pack(docs, "blocks", BLOCK_BYTES)
    size = blocks.agg(F.sum("size")).first()[0] or 0
    slices = slices_for(size // 100, SLICE_WORDS)
    asked = materialize(each_block(blocks, lambda b, p: _ask(b, p, folds, held_out, slices), QUESTION), "words")
    by_slice = asked.where("slice >= 0").groupBy("slice")

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        total = {w: n for w, n in _added_up([_read(q) for q in frame["question"]]).items() if n}
        counts = np.array(list(total.values()), np.float64)
        used = Lattice(pieces, start).expected([b" " + w for w in total], counts) if total else np.zeros(len(pieces))
        rows = [(-1, counts.sum()), (-2, float(len(total))), *((int(n), used[n]) for n in np.flatnonzero(used))]
        return pd.DataFrame(rows, columns=["piece", "used"])

    # At most one row for each piece of the vocabulary, and two.
    learned = by_slice.applyInPandas(learn, "piece int, used double").groupBy("piece").agg(
        F.sum(F.round(F.col("used").cast("decimal(38,6)"), 6)).alias("used")).collect()
    used = {r.piece: float(r.used) for r in learned}
    ends = asked.where("slice = -1").agg(F.sum(F.conv(F.hex("question"), 16, 10).cast("long"))).first()[0] or 0
    train_words, types = int(used.pop(-1, 0)), int(used.pop(-2, 0))
    train_tokens, distinct = train_words + ends, types + (ends > 0)
    weights = PRIOR * np.exp(start)
    for piece, count in used.items():
        weights[piece] += count
    weights = np.log(weights / weights.sum())
    end_share = (ends + 1) / (train_tokens + 2)
    fresh = max(types, 1)  # the lattice's weight against the words' counts

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [_read(q) for q in frame["question"]]
        total = _added_up(parts)
        cuts = Lattice(pieces, weights).log_probability([b" " + w for w in total])
        with np.errstate(divide="ignore"):
            seen = np.log(np.array(list(total.values()), np.float64))
        mixed = np.logaddexp(seen, math.log(fresh) + cuts) - math.log(train_words + fresh)
        likely = dict(zip(total, mixed, strict=True))
        return pd.DataFrame({"block": frame["block"], "slice": frame["slice"], "answer": [
            np.array([[total[w] for w in names], [likely[w] for w in names]]).tobytes() for names, _ in parts]})

    answers = by_slice.applyInPandas(
        lambda frame: answer(frame).assign(answer=lambda f: [squeeze(a) for a in f["answer"]]), ANSWER)
    bottom = math.log10(train_tokens + 0.1 * (distinct + 1))

    def finish(block: int, payload: bytes, given: dict[int, bytes]) -> pd.DataFrame:
        own = _Words(payload, folds, slices)
        found = [expand(given[int(s)], "f8").reshape(2, -1) for s in np.unique(own.slice)]
        counts, likely = np.concatenate(found, axis=1) if found else np.empty((2, 0))
        size = len(own.ids)

        def add(values: np.ndarray) -> np.ndarray:
            return np.bincount(own.doc, values[own.which], size)

        tokens = np.bincount(own.doc, minlength=size) + 1
        base = add(np.log10(counts + 0.1)) + math.log10(ends + 0.1) - tokens * bottom
        whole = (add(likely) + (tokens - 1) * math.log1p(-end_share) + math.log(end_share)) / math.log(10)
        return pd.DataFrame({
            "doc_id": pd.array(own.ids, "Int64"), "held_out": own.fold == held_out, "n_tokens": tokens,
            "n_known": (add((counts > 0).astype(float)) + (ends > 0)).astype(np.int64),
            "train_tokens": np.int64(train_tokens), "base_score": base, "score": whole})

    return each_answered(
        blocks, answers, finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
                                 " base_score double, score double")
