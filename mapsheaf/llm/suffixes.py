"""Suffix order of one array by the difference-cover method, as far as a prefix length.

Positions that are 1 or 2 modulo 3 are the sample: their triples are sorted and named,
and the names form a text that is sorted the same way unless the names already differ or
already cover the length asked for. The remaining suffixes follow from their first symbol
and the rank of the sample suffix behind it; then both orders are merged by rank.
"""

from __future__ import annotations

import numpy as np


def _named(keys: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of keys (the first is the most significant), and a dense rank from 1 of each row."""
    widths = [int(key.max()).bit_length() if len(key) else 0 for key in keys]
    if sum(widths) < 64:
        # Keys that fit into one whole number are sorted as one.
        joined = np.zeros(len(keys[0]), np.int64)
        for key, width in zip(keys, widths, strict=True):
            joined = joined << width | key.astype(np.int64)
        keys, order = (joined,), np.argsort(joined)
    else:
        order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def ranks(symbols: np.ndarray, length: int) -> np.ndarray:
    """Rank of each suffix of ``symbols`` by at least its first ``length`` symbols.

    Equal ranks mean equal prefixes of that length; ``symbols`` are whole numbers above 0.
    """
    size = len(symbols)
    if length <= 3 or size < 3:
        padded = np.append(symbols, np.zeros(2, symbols.dtype))
        return _named((padded[:size], padded[1:size + 1], padded[2:size + 2])[:max(1, min(3, length))])[1]
    padded = np.append(symbols, np.zeros(3, symbols.dtype))
    sample = [np.arange(1, size, 3), np.arange(2, size, 3)]
    at = np.concatenate(sample)
    _, names = _named((padded[at], padded[at + 1], padded[at + 2]))
    if names.max() < len(names):
        # A text of names: all of one residue, a stop, then all of the other.
        stop = len(sample[0])
        recursed = ranks(np.concatenate([names[:stop], [0], names[stop:]]) + 1, -(-length // 3))
        names = np.concatenate([recursed[:stop], recursed[stop + 1:]])
    rank = np.zeros(size + 3, np.int64)
    rank[at] = names
    # Merge: compare each remaining suffix with the sample suffixes of either residue, by
    # its first symbols and the rank behind them; keys of equal form compare.
    rest = np.arange(0, size, 3)
    below, equal = np.zeros(len(rest), np.int64), np.zeros(len(rest), bool)
    keys = (lambda n: (padded[n], rank[n + 1]), lambda n: (padded[n], padded[n + 1], rank[n + 2]))
    for other, key in zip(sample, keys, strict=True):
        _, merged = _named(key(np.concatenate([rest, other])))
        mine, theirs = merged[:len(rest)], np.sort(merged[len(rest):])
        first = np.searchsorted(theirs, mine, "left")
        below += first
        equal |= first < np.searchsorted(theirs, mine, "right")
    # Sample suffixes below come first; a suffix equal to one of them ranks with it.
    _, own = _named((padded[rest], rank[rest + 1]))
    place, turn = np.empty(size, np.int64), np.zeros(size, np.int64)
    place[at] = 2 * np.searchsorted(np.sort(names), names, "left") + 1
    place[rest] = 2 * below + equal
    turn[rest] = np.where(equal, 0, own)
    return _named((place, turn))[1]


def prefix_classes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A class number for the ``length`` bytes from each of ``starts``: equal for equal bytes.

    Eight bytes are one symbol, so the text is eight interleaved strings. The suffixes are
    sorted, and neighbours in that order are compared byte by byte.
    """
    padded = np.concatenate([text, np.zeros(length + 16, np.uint8)])
    size = len(text) + 8
    symbol = np.zeros(size, np.uint64)
    for n in range(8):
        symbol = symbol << np.uint64(8) | padded[n:n + size]
    turns = -(-size // 8)
    table = np.zeros((turns, 8), np.uint64)
    table.ravel()[:size] = symbol
    _, dense = np.unique(table.T, return_inverse=True)
    strings = np.zeros((8, turns + 1), np.int64)  # each ends in a stop
    strings[:, :turns] = dense.reshape(8, turns) + 2
    strings[:, turns] = 1
    rank = ranks(strings.ravel(), -(-length // 8))
    own = rank[(starts % 8) * (turns + 1) + starts // 8]
    order = np.argsort(own, kind="stable")
    at = starts[order]
    differ = np.zeros(len(order), bool)
    differ[:1] = True
    for part in range(1, len(order), 1 << 15):
        rows = slice(part, part + (1 << 15))
        here = at[rows][:, None] + np.arange(length)
        there = at[part - 1:part - 1 + len(here)][:, None] + np.arange(length)
        differ[rows] = (padded[here] != padded[there]).any(axis=1)
    classes = np.empty(len(order), np.int64)
    classes[order] = np.cumsum(differ) - 1
    return classes
