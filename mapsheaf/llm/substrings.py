"""Repeated windows of words, with a count-min sketch before the exact grouping.

A window is ``window`` consecutive words of a document. A word goes if a window that
covers it also starts in a document with a smaller id.

First pass: each block hashes its windows and sends each slice of the hash range the
distinct hashes it saw there, with a mark for those it saw twice: its part of a count-min
sketch. A slice adds the parts of all blocks up in ``DEPTH`` rows of counters and answers
which windows have an estimate above one. Counters only overestimate, so no repeated
window is lost. Second pass: blocks send 128-bit digests of those windows only, each with
the smallest id of the block that has it, and learn whether a block has a smaller one.
The last pass removes words.

A null text has no words. Rows without ``doc_id`` lose nothing and remove nothing; rows
that repeat an id are one document. Texts of any length are taken whole; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm import words
from mapsheaf.llm.blocks import (
    BLOCK_BYTES, QUESTION, each_answered, each_block, each_slice, expand, pack, questions, read_sorted, slice_of, slices_for,
    squeeze, unpack, write_sorted,
)

DEPTH = 3
WIDTH_BITS = 23
SLICE_WINDOWS = 1 << 19
SLICE_DIGESTS = 1 << 18
# Odd multipliers, one for each row of counters.
_ROWS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


class _Windows:
    """The windows of a block."""

    def __init__(self, payload: bytes, window: int) -> None:
        self.window = window
        self.ids, texts = unpack(payload)
        self.data, self.starts, self.ends, self.doc = words.split(texts)
        known = np.array([n is not None for n in self.ids], bool)
        self.number = np.array([n or 0 for n in self.ids], np.int64)
        hashes = words.hashes(self.data, self.starts, self.ends)
        count = max(0, len(hashes) - window + 1)
        total = np.zeros(count, np.uint64)
        for n in range(window):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[n:n + count]
        whole = self.doc[:count] == self.doc[window - 1:]
        self.first = np.flatnonzero(whole & known[self.doc[:count]])  # first word of each window
        self.hash = words.mix(total[self.first])

    def keys(self, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct slice and 32-bit hash of the windows, how often, and which window has which."""
        low = self.hash & np.uint64(0xFFFFFFFF)
        key = slice_of(self.hash, slices).astype(np.uint64) << np.uint64(32) | low
        return np.unique(key, return_inverse=True, return_counts=True)

    def repeated(self, slices: int, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose estimate is above one, and the digest of each."""
        key, which, _ = self.keys(slices)
        at = self.first[_flags(key >> np.uint64(32), answers)[which]]
        # Words of a window with one blank between them, as bytes.
        lengths = self.ends - self.starts + 1
        to = np.cumsum(lengths)
        blanks = np.ones(to[-1] if len(to) else 0, np.int64)
        blanks[to[:-1]] = self.starts[1:] - self.ends[:-1]
        if len(blanks):
            blanks[0] = self.starts[0]
        text = self.data[np.cumsum(blanks)].copy()
        text[to - 1] = 32
        text, begin = text.tobytes(), to - lengths
        digests = [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(
            begin[at].tolist(), (to[at + self.window - 1] - 1).tolist(), strict=True)]
        return at, np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64)


def _flags(slice_numbers: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """The answered bits of keys that are sorted by slice."""
    found, counts = np.unique(slice_numbers, return_counts=True)
    parts = [np.unpackbits(np.frombuffer(answers[int(s)], np.uint8), count=int(n))
             for s, n in zip(found, counts, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)


def _ask_sketch(block: int, payload: bytes, window: int, slices: int) -> pd.DataFrame:
    key, _, counts = _Windows(payload, window).keys(slices)
    low, twice = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), counts > 1

    def write(part: slice) -> bytes:
        cells = write_sorted(low[part])
        return len(cells).to_bytes(4, "little") + cells + np.packbits(twice[part]).tobytes()

    return questions(block, (key >> np.uint64(32)).astype(np.int32), write)


def _merge_sketches(parts: list[bytes], width_bits: int) -> Iterator[bytes]:
    cells, twice = [], []
    for part in parts:
        size = int.from_bytes(part[:4], "little")
        cells.append(read_sorted(part[4:4 + size], "u4"))
        twice.append(np.unpackbits(np.frombuffer(part[4 + size:], np.uint8), count=len(cells[-1])))
    every, weight = np.concatenate(cells), np.concatenate(twice) + 1
    estimate = np.full(len(every), 255, np.uint8)
    for multiplier in _ROWS[:DEPTH]:
        row = (every * np.uint32(multiplier)) >> np.uint32(32 - width_bits)
        counters = np.bincount(row, minlength=1 << width_bits)
        counters += np.bincount(row[weight > 1], minlength=1 << width_bits)
        estimate = np.minimum(estimate, np.minimum(counters[row], 255).astype(np.uint8))
    for part in np.split(estimate > 1, np.cumsum([len(c) for c in cells])[:-1]):
        yield np.packbits(part).tobytes()


def _owned(found: _Windows, at: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct digests in order, the smallest id that has each, and which window has which."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    new = np.ones(len(ordered), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    least = np.full(int(new.sum()), np.iinfo(np.int64).max)
    np.minimum.at(least, which, found.number[found.doc[at]])
    return ordered[new], least, which


def _ask_digests(block: int, payload: bytes, answers: dict[int, bytes], window: int, slices: int,
                 digest_slices: int) -> pd.DataFrame:
    found = _Windows(payload, window)
    distinct, least, _ = _owned(found, *found.repeated(slices, answers))

    def write(part: slice) -> bytes:
        ids = squeeze(np.ascontiguousarray(least[part].view(np.uint8).reshape(-1, 8).T))
        return len(ids).to_bytes(4, "little") + ids + distinct[part].tobytes()

    return questions(block, slice_of(distinct[:, 0], digest_slices), write)


def _least_owner(parts: list[bytes]) -> Iterator[bytes]:
    """For each digest of each part: has another part a smaller id?"""
    digests, least = [], []
    for part in parts:
        size = int.from_bytes(part[:4], "little")
        digests.append(np.frombuffer(part[4 + size:], np.uint64).reshape(-1, 2))
        least.append(np.ascontiguousarray(expand(part[4:4 + size], "u1").reshape(8, -1).T).view(np.int64)[:, 0])
    every, owner = np.concatenate(digests), np.concatenate(least)
    order = np.lexsort((owner, every[:, 1], every[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (every[order[1:]] != every[order[:-1]]).any(axis=1)
    smallest = owner[order][new][np.cumsum(new) - 1]
    later = np.empty(len(order), bool)
    later[order] = owner[order] > smallest
    for part in np.split(later, np.cumsum([len(d) for d in digests])[:-1]):
        yield np.packbits(part).tobytes()


def _remove(block: int, payload: bytes, answers: dict[int, bytes], window: int, slices: int,
            digest_slices: int) -> pd.DataFrame:
    sketch = {n: blob for n, blob in answers.items() if n < slices}
    exact = {n - slices: blob for n, blob in answers.items() if n >= slices}
    found = _Windows(payload, window)
    at, digests = found.repeated(slices, sketch)
    distinct, least, which = _owned(found, at, digests)
    later = _flags(slice_of(distinct[:, 0], digest_slices), exact)
    gone = later[which] | (found.number[found.doc[at]] > least[which])
    change = np.zeros(len(found.starts) + 1, np.int64)
    np.add.at(change, at[gone], 1)
    np.add.at(change, at[gone] + window, -1)
    removed = np.cumsum(change[:-1]) > 0
    text, rows = found.data.tobytes(), []
    edges = np.searchsorted(found.doc, np.arange(len(found.ids) + 1))
    for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        keep = np.flatnonzero(~removed[a:b]) + a
        kept = b" ".join([text[x:y] for x, y in zip(found.starts[keep].tolist(), found.ends[keep].tolist(), strict=True)])
        rows.append((found.ids[n], int(b - a), int(b - a - len(keep)), kept.decode()))
    out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def remove_repeats(docs: DataFrame, window: int = 13, block_bytes: int = BLOCK_BYTES,
                   width_bits: int = WIDTH_BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row; ``kept`` joins the words that stay."""
    blocks = pack(docs, "blocks", block_bytes)
    # Windows number fewer than words, and words fewer than half the bytes and one.
    size = blocks.agg(F.sum("size")).first()[0] or 0
    slices = slices_for(size // 6, SLICE_WINDOWS)
    asked = each_block(blocks, lambda b, p: _ask_sketch(b, p, window, slices), QUESTION)
    sketch = each_slice(asked, lambda parts: _merge_sketches(parts, width_bits), "sketch")
    digest_slices = slices_for(size // 24, SLICE_DIGESTS)
    asked = each_answered(
        blocks, sketch, lambda b, p, a: _ask_digests(b, p, a, window, slices, digest_slices), QUESTION)
    exact = each_slice(asked, _least_owner, "digests")
    answers = sketch.union(exact.select("block", (F.col("slice") + slices).cast("int"), "answer"))
    return each_answered(
        blocks, answers, lambda b, p, a: _remove(b, p, a, window, slices, digest_slices),
        "doc_id long, n_words long, n_removed long, kept string")
