"""Removal of repeated byte strings through suffix order.

Every byte goes that is covered by a string of ``length`` bytes which also starts earlier:
in a document with a smaller id, or earlier in the same one.

To sort only what may repeat, each string (a window) is given to the one of its
``length/2``-byte grams with the least hash, its anchor; equal windows have equal anchors
at equal places. First pass: blocks ask slices which anchors occur more than once. Second
pass: they send those anchors' surroundings to the slice of the anchor's hash, so equal
windows meet in one task. There equal surroundings are taken once, an anchor with one kind
of surroundings is settled, and windows whose rolling hash is alone are left out. The rest
is sorted by the difference-cover method and neighbours in that order are compared byte
by byte. The last pass removes bytes.

Surroundings that a block holds many times are sent once, with their earliest place, and
a slice keeps one of each, so copies do not pile up in one task. An anchor that many blocks
hold, say in a passage common to a third of all documents, is split: each of its windows goes
to the slice of the window's own hash.

A null text is empty. Rows without ``doc_id`` lose nothing and remove nothing; rows that
repeat an id are one document, so a place in them is not earlier than the same place in
its twin. Texts of any length are taken whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm import words
from mapsheaf.llm.blocks import (
    BLOCK_BYTES, QUESTION, each_answered, each_block, each_slice, expand, pack, questions, read_sorted, slice_of, slices_for,
    squeeze, unpack, write_sorted,
)
from mapsheaf.llm.suffixes import prefix_classes

# Places whose grams are hashed at a time; arrays of this size stay in a processor's cache.
CHUNK = 1 << 16
SLICE_ANCHORS = 1 << 17
# An anchor in more blocks than this is split: each of its windows is sent by its own hash. That
# moves some twenty times the bytes for such an anchor, so it is for those that would crowd a task.
HOT_BLOCKS = 4096
_LOW = np.uint64(0xFFFFFFFF)


class _Anchors:
    """The windows of a block by anchor: runs of window starts that share one."""

    def __init__(self, payload: bytes, length: int) -> None:
        self.length, self.gram = length, length // 2
        self.ids, texts = unpack(payload)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.edges = np.cumsum([0, *map(len, texts)])
        known = np.array([n is not None for n in self.ids], bool)
        parts = [self._chunk(start, known) for start in range(0, max(0, len(self.data) - length + 1), CHUNK)]
        kinds = (np.int64, np.int64, np.uint64, np.int64)
        self.first, self.at, self.hash, self.doc = (
            np.concatenate([part[n] for part in parts]) if parts else np.empty(0, kind) for n, kind in enumerate(kinds))
        self.count = np.concatenate([part[4] for part in parts]) if parts else np.empty(0, np.int64)
        # A run that goes on in the next chunk is one run.
        new = np.ones(len(self.first), bool)
        new[1:] = (self.at[1:] != self.at[:-1]) | (self.doc[1:] != self.doc[:-1])
        starts = np.flatnonzero(new)
        if len(starts):
            self.count = np.add.reduceat(self.count, starts)
        self.first, self.at, self.hash, self.doc = self.first[new], self.at[new], self.hash[new], self.doc[new]

    def _chunk(self, start: int, known: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of windows from ``start`` on: first window, anchor, its hash, document and length."""
        end = min(len(self.data), start + CHUNK + self.length - 1)
        places = np.arange(start, end - self.gram + 1)
        hashes = words.rolling(self.data[start:end], self.gram)
        # The hash's upper half, then the place: the first of equal grams counts.
        least = (hashes & ~_LOW) | np.arange(len(places), dtype=np.uint64)
        span, wide = 1, self.length - self.gram + 1
        while span * 2 <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if wide > span:
            least = np.minimum(least[:len(least) - (wide - span)], least[wide - span:])
        at = (least & _LOW).astype(np.int64)
        first = places[:len(at)]
        # Places rise by one, so documents come in runs.
        low, high = np.searchsorted(self.edges, [start, start + len(first) - 1], "right") - 1
        ends = np.minimum(self.edges[low + 1:high + 2], start + len(first))
        sizes = np.diff(ends, prepend=start)
        doc = np.repeat(np.arange(low, high + 1), sizes)
        last = np.where(known[low:high + 1], self.edges[low + 1:high + 2] - self.length, -1)
        whole = np.flatnonzero(first <= np.repeat(last, sizes))
        first, at, doc = first[whole], at[whole], doc[whole]
        new = np.ones(len(first), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        runs = np.flatnonzero(new)
        # Anchors have low hashes; mixing spreads them over the slices.
        return (first[runs], at[runs] + start, words.mix(hashes[at[runs]]), doc[runs],
                np.diff(np.append(runs, len(first))))

    def keys(self, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = slice_of(self.hash, slices).astype(np.uint64) << np.uint64(32) | (self.hash & _LOW)
        return np.unique(key, return_inverse=True, return_counts=True)

    def entries(self, slices: int, answers: dict[int, bytes]) -> _Entries:
        """What may repeat elsewhere: whole runs, or single windows of anchors that many blocks hold."""
        key, which, _ = self.keys(slices)
        many, hot = [], []
        for number, size in zip(*np.unique(key >> np.uint64(32), return_counts=True), strict=True):
            bits = np.frombuffer(answers[int(number)], np.uint8).reshape(2, -1)
            many.append(np.unpackbits(bits[0], count=int(size)))
            hot.append(np.unpackbits(bits[1], count=int(size)))
        runs = np.flatnonzero(np.concatenate(many).astype(bool)[which]) if many else np.empty(0, np.int64)
        split = np.concatenate(hot).astype(bool)[which][runs] if hot else np.empty(0, bool)
        pieces = np.where(split, self.count[runs], 1)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        of, single = np.repeat(runs, pieces), np.repeat(split, pieces)
        first, hashes = self.first[of] + within, self.hash[of]
        alone = first[single]
        hashes[single] = words.mix(words.hashes(self.data, alone, alone + self.length))
        return _Entries(self, first, np.where(single, 1, self.count[of]), self.at[of], hashes, self.doc[of])


class _Entries:
    """Windows to be compared, with what they cover and the earliest entry of the block that covers the same."""

    def __init__(self, own: _Anchors, first: np.ndarray, count: np.ndarray, at: np.ndarray, hashes: np.ndarray,
                 doc: np.ndarray) -> None:
        self.first, self.count, self.hash = first, count, hashes
        raw = own.data.tobytes()
        self.texts = [bytes((a - s, c - 1)) + raw[s:s + c + own.length - 1] for s, c, a in zip(
            first.tolist(), count.tolist(), at.tolist(), strict=True)]
        self.number = np.array([n or 0 for n in own.ids], np.int64)[doc]
        self.offset = first - own.edges[doc]
        self.owner = _owners(self.texts, self.number, self.offset)

    def sent(self, slices: int) -> np.ndarray:
        """The entries that are sent, sorted by slice: the earliest of each text in the block."""
        sent = np.flatnonzero(self.owner == np.arange(len(self.owner)))
        return sent[np.argsort(slice_of(self.hash[sent], slices), kind="stable")]


def _owners(texts: list[bytes], number: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """For each text the equal one of the smallest place."""
    earliest: dict[bytes, int] = {}
    owner = np.empty(len(texts), np.int64)
    for n in np.lexsort((offset, number)).tolist():
        owner[n] = earliest.setdefault(texts[n], n)
    return owner


def _ask_anchors(block: int, payload: bytes, length: int, slices: int) -> pd.DataFrame:
    key, _, counts = _Anchors(payload, length).keys(slices)
    low, twice = (key & _LOW).astype(np.uint32), counts > 1

    def write(part: slice) -> bytes:
        cells = write_sorted(low[part])
        return len(cells).to_bytes(4, "little") + cells + np.packbits(twice[part]).tobytes()

    return questions(block, (key >> np.uint64(32)).astype(np.int32), write)


def _repeated(parts: list[bytes], hot_blocks: int) -> Iterator[bytes]:
    """Two bits for each key of each part: does it repeat, and do more blocks than ``hot_blocks`` hold it?"""
    cells, twice = [], []
    for part in parts:
        size = int.from_bytes(part[:4], "little")
        cells.append(read_sorted(part[4:4 + size], "u4"))
        twice.append(np.unpackbits(np.frombuffer(part[4 + size:], np.uint8), count=len(cells[-1])))
    _, which, counts = np.unique(np.concatenate(cells), return_inverse=True, return_counts=True)
    many = (counts + np.bincount(which, np.concatenate(twice)) > 1)[which]
    hot = (counts > hot_blocks)[which]
    ends = np.cumsum([len(c) for c in cells])[:-1]
    for one, other in zip(np.split(many, ends), np.split(hot, ends), strict=True):
        yield np.packbits(one).tobytes() + np.packbits(other).tobytes()


def _ask_windows(block: int, payload: bytes, answers: dict[int, bytes], length: int, slices: int) -> pd.DataFrame:
    found = _Anchors(payload, length).entries(slices, answers)
    sent = found.sent(slices)

    def write(part: slice) -> bytes:
        rows = sent[part]
        numbers = np.stack([found.number[rows], found.offset[rows], found.hash[rows].view(np.int64)])
        columns = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T)
        return squeeze(len(rows).to_bytes(4, "little") + columns.tobytes() + b"".join([found.texts[n] for n in rows]))

    return questions(block, slice_of(found.hash[sent], slices), write)


def _earlier(parts: list[bytes], length: int) -> Iterator[bytes]:
    """For each window of each part: does an equal one start earlier?"""
    counts, rows, texts = [], [], []
    for part in parts:
        data = expand(part)
        size = int.from_bytes(data[:4], "little")
        columns = np.frombuffer(data[4:4 + 24 * size], np.uint8).reshape(8, -1).T
        rows.append(np.ascontiguousarray(columns).view(np.int64).reshape(3, size))
        at = 4 + 24 * size
        for _ in range(size):
            end = at + 2 + data[at + 1] + length
            texts.append(data[at:end])
            at = end
        counts.append(size)
    number, offset, anchor = np.concatenate(rows, axis=1)
    owner = _owners(texts, number, offset)
    heads = owner == np.arange(len(texts))
    _, group = np.unique(anchor, return_inverse=True)
    kinds = np.bincount(group, heads)
    open_ = np.flatnonzero(heads & (kinds[group] > 1))
    windows = np.array([text[1] + 1 for text in texts], np.int64)
    gone = [np.zeros(n, bool) for n in windows.tolist()]
    if len(open_):
        for n, part in zip(open_, _sorted_classes([texts[n] for n in open_], number[open_], offset[open_], length), strict=True):
            gone[n] = part
    for n in np.flatnonzero(~heads):
        first = owner[n]
        later = number[n] > number[first] or offset[n] > offset[first]
        gone[n] = np.ones(windows[n], bool) if later else gone[first]
    edges = np.cumsum([0, *counts])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield np.packbits(np.concatenate(gone[a:b])).tobytes() if b > a else b""


def _sorted_classes(texts: list[bytes], number: np.ndarray, offset: np.ndarray, length: int) -> list[np.ndarray]:
    """Windows of different surroundings that have an equal one at a smaller place."""
    text = np.frombuffer(b"".join([t[2:] for t in texts]), np.uint8)
    windows = np.array([t[1] + 1 for t in texts], np.int64)
    begin = np.cumsum(np.append(0, windows + length - 1))[:-1]
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.repeat(begin, windows) + within
    number, offset = np.repeat(number, windows), np.repeat(offset, windows) + within
    _, which, counts = np.unique(words.hashes(text, start, start + length), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts[which] > 1)
    gone = np.zeros(len(start), bool)
    if len(shared):
        # Only the bytes that some remaining window covers are sorted.
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, start[shared], 1)
        np.add.at(cover, start[shared] + length, -1)
        kept = np.cumsum(cover[:-1]) > 0
        place = np.cumsum(kept) - 1
        classes = prefix_classes(text[kept], place[start[shared]], length)
        order = np.lexsort((offset[shared], number[shared], classes))
        ordered = shared[order]
        new = np.ones(len(order), bool)
        new[1:] = classes[order[1:]] != classes[order[:-1]]
        head = ordered[np.flatnonzero(new)[np.cumsum(new) - 1]]
        gone[ordered] = (number[ordered] != number[head]) | (offset[ordered] != offset[head])
    return np.split(gone, np.cumsum(windows)[:-1])


def _sizes(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices that occur in sorted ``numbers``, and the sum of the counts of each."""
    starts = np.flatnonzero(np.diff(numbers, prepend=-1))
    return numbers[starts], np.add.reduceat(counts, starts) if len(starts) else starts


def _remove(block: int, payload: bytes, answers: dict[int, bytes], length: int, slices: int) -> pd.DataFrame:
    found = _Anchors(payload, length)
    entries = found.entries(slices, {n: a for n, a in answers.items() if n < slices})
    sent, sizes, owner = entries.sent(slices), entries.count, entries.owner
    numbers = slice_of(entries.hash[sent], slices)
    parts = [np.unpackbits(np.frombuffer(answers[int(part) + slices], np.uint8), count=int(size))
             for part, size in zip(*_sizes(numbers, sizes[sent]), strict=True)]
    bits = np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)
    begin = np.zeros(len(sizes), np.int64)  # where the answered bits of an entry start
    begin[sent] = np.cumsum(sizes[sent]) - sizes[sent]
    later = (entries.number != entries.number[owner]) | (entries.offset != entries.offset[owner])
    # All windows of a later copy go; of the others those that were answered so.
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    gone = np.repeat(later, sizes)
    asked = np.flatnonzero(~gone)
    gone[asked] = bits[(np.repeat(begin[owner], sizes) + within)[asked]]
    starts = (np.repeat(entries.first, sizes) + within)[gone]
    change = np.bincount(starts, minlength=len(found.data) + 1)
    change -= np.bincount(starts + length, minlength=len(found.data) + 1)
    removed = np.cumsum(change[:-1]) > 0
    rows = []
    for n, (a, b) in enumerate(zip(found.edges[:-1], found.edges[1:], strict=True)):
        part = removed[a:b]
        spans = int(part[:1].sum() + (part[1:] & ~part[:-1]).sum())
        rows.append((int(b - a), int(part.sum()), spans, found.data[a:b][~part].tobytes()))
    out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])
    out.insert(0, "doc_id", pd.array(found.ids, "Int64"))
    return out


def remove_repeated_bytes(docs: DataFrame, length: int = 100, block_bytes: int = BLOCK_BYTES,
                          hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary) for every row of ``docs``."""
    if not 16 <= length <= 400:
        raise ValueError("length must be from 16 to 400 bytes")
    blocks = pack(docs, "blocks", block_bytes)
    size = blocks.agg(F.sum("size")).first()[0] or 0
    # One anchor for about every quarter of the length.
    slices = slices_for(size * 4 // length, SLICE_ANCHORS)
    asked = each_block(blocks, lambda b, p: _ask_anchors(b, p, length, slices), QUESTION)
    repeated = each_slice(asked, lambda parts: _repeated(parts, hot_blocks), "anchors")
    asked = each_answered(blocks, repeated, lambda b, p, a: _ask_windows(b, p, a, length, slices), QUESTION)
    earlier = each_slice(asked, lambda parts: _earlier(parts, length), "windows")
    answers = repeated.union(earlier.select("block", (F.col("slice") + slices).cast("int"), "answer"))
    return each_answered(
        blocks, answers, lambda b, p, a: _remove(b, p, a, length, slices),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
