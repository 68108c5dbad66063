"""Well-known binary as arrays of coordinates, a batch at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from mapsheaf.functions.mercator import MAX_LATITUDE

POINT, LINE, AREA = 1, 2, 3
# How a position follows a header: bytes of a double, of a count.
_DOUBLE, _COUNT = 8, 4


@dataclass
class Paths:
    """Points, lines and rings of a batch, one after the other.

    ``owner``: the row a path is of; ``kind``: point, line or ring; ``hole``: whether a ring is one;
    ``first``: where its positions begin in ``x`` and ``y``, with the end of all at last.
    """

    owner: np.ndarray
    kind: np.ndarray
    hole: np.ndarray
    first: np.ndarray
    x: np.ndarray
    y: np.ndarray

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """Position numbers at which a segment begins, and the path of each."""
        path = np.repeat(np.arange(len(self.owner)), np.diff(self.first))
        begins = np.ones(len(self.x), bool)
        begins[self.first[1:] - 1] = False
        at = np.flatnonzero(begins)
        return at, path[at]


def _whole(data: np.ndarray, at: np.ndarray, little: np.ndarray) -> np.ndarray:
    """Unsigned 32-bit numbers at byte positions."""
    four = data[at[:, None] + np.arange(4)].astype(np.int64)
    four = np.where(little[:, None], four[:, ::-1], four)
    return (four[:, 0] << 24) | (four[:, 1] << 16) | (four[:, 2] << 8) | four[:, 3]


def decode(geometry: pa.Array) -> Paths:
    """The paths of every geometry; nulls and what cannot be read have none.

    All geometries are read side by side, one header or run of positions a step, so a
    batch takes as many steps as its largest geometry has parts. A geometry whose bytes
    end too soon counts as unreadable as a whole.
    """
    geometry = geometry.cast(pa.large_binary())
    buffers = geometry.buffers()
    data = np.frombuffer(buffers[2] or b"", np.uint8)
    edge = np.frombuffer(buffers[1], np.int64)[geometry.offset:geometry.offset + len(geometry) + 1]
    row = np.flatnonzero(np.asarray(geometry.is_valid()) & (np.diff(edge) > 0))
    at, end = edge[row].copy(), edge[row + 1]
    items = np.ones(len(row), np.int64)  # geometries still to come
    rings = np.zeros(len(row), np.int64)  # rings still to come of the area at hand
    begun = np.zeros(len(row), bool)  # whether its outer ring has been read
    little = np.zeros(len(row), bool)
    size = np.full(len(row), 2)
    broken = np.zeros(geometry.offset + len(geometry) + 1, bool)
    found: list[tuple[np.ndarray, ...]] = []

    def fail(which: np.ndarray) -> None:
        broken[row[which]] = True
        items[which], rings[which] = 0, 0

    def runs(which: np.ndarray, counts: np.ndarray, kind: np.ndarray, hole: np.ndarray) -> None:
        """Positions at ``at``."""
        bytes_ = counts * size[which] * _DOUBLE
        good = at[which] + bytes_ <= end[which]
        fail(which[~good])
        which, counts, kind, hole, bytes_ = (v[good] for v in (which, counts, kind, hole, bytes_))
        found.append((row[which], at[which].copy(), counts, size[which], little[which], kind, hole))
        at[which] += bytes_

    while True:
        active = np.flatnonzero((items > 0) | (rings > 0))
        if not len(active):
            break
        # Rings: a count and its positions.
        ring = active[rings[active] > 0]
        short = at[ring] + _COUNT > end[ring]
        fail(ring[short])
        ring = ring[~short]
        if len(ring):
            counts = _whole(data, at[ring], little[ring])
            at[ring] += _COUNT
            rings[ring] -= 1
            runs(ring, counts, np.full(len(ring), AREA), begun[ring])
            begun[ring] = True
        # Headers: byte order, kind, and what comes with it.
        head = active[(rings[active] == 0) & (items[active] > 0) & ~np.isin(active, ring)]
        short = at[head] + 1 + _COUNT > end[head]
        fail(head[short])
        head = head[~short]
        if not len(head):
            continue
        little[head] = data[at[head]] == 1
        code = _whole(data, at[head] + 1, little[head])
        at[head] += 1 + _COUNT
        at[head] += np.where(code & 0x20000000, _COUNT, 0)  # a coordinate system number
        plain = np.where(code < 0x10000000, code % 1000, code & 0xFF)
        thousand = np.where(code < 0x10000000, code // 1000, 0)
        size[head] = (2 + ((code & 0x80000000 != 0) | np.isin(thousand, (1, 3)))
                      + ((code & 0x40000000 != 0) | np.isin(thousand, (2, 3))))
        fail(head[(plain < 1) | (plain > 7)])
        point = head[plain == POINT]
        items[point] -= 1
        runs(point, np.ones(len(point), np.int64), np.full(len(point), POINT), np.zeros(len(point), bool))
        more = (plain >= LINE) & (plain <= 7)
        short = more & (at[head] + _COUNT > end[head])
        fail(head[short])
        more &= ~short
        which, plain = head[more], plain[more]
        counts = _whole(data, at[which], little[which])
        at[which] += _COUNT
        items[which] -= 1
        line = plain == LINE
        runs(which[line], counts[line], np.full(line.sum(), LINE), np.zeros(line.sum(), bool))
        area = plain == AREA
        rings[which[area]], begun[which[area]] = counts[area], False
        items[which[plain > AREA]] += counts[plain > AREA]

    if not found:
        none = np.empty(0)
        return Paths(none.astype(int), none.astype(int), none.astype(bool), np.zeros(1, int), none, none)
    owner, start, counts, width, order, kind, hole = (np.concatenate(part) for part in zip(*found, strict=True))
    keep = ~broken[owner] & (counts > 0)
    # By row, and within it as read.
    sequence = np.flatnonzero(keep)[np.argsort(owner[keep], kind="stable")]
    owner, start, counts, width, order, kind, hole = (
        v[sequence] for v in (owner, start, counts, width, order, kind, hole))
    first = np.concatenate([[0], np.cumsum(counts)])
    path = np.repeat(np.arange(len(owner)), counts)
    place = start[path] + (np.arange(first[-1]) - first[path]) * width[path] * _DOUBLE

    def numbers(shift: int) -> np.ndarray:
        eight = data[(place + shift)[:, None] + np.arange(_DOUBLE)]
        swapped = ~order[path]
        eight[swapped] = eight[swapped][:, ::-1]
        return np.ascontiguousarray(eight).view("<f8")[:, 0]

    x, y = numbers(0), numbers(_DOUBLE)
    good = np.isfinite(x) & np.isfinite(y)
    if not good.all():  # empty points, and paths with sides that are no numbers
        bad = np.zeros(len(owner), bool)
        bad[path[~good]] = True
        stay = ~bad[path]
        return Paths(owner[~bad], kind[~bad], hole[~bad], np.concatenate([[0], np.cumsum(counts[~bad])]), x[stay], y[stay])
    return Paths(owner, kind, hole, first, x, y)


def to_world(paths: Paths) -> Paths:
    """Longitudes and latitudes as places of the Mercator world, 0 to 1 from its north-western corner."""
    angle = np.clip(paths.y, -MAX_LATITUDE, MAX_LATITUDE) * np.pi / 180
    y = (1 - np.log(np.tan(angle) + 1 / np.cos(angle)) / np.pi) / 2
    return Paths(paths.owner, paths.kind, paths.hole, paths.first, (paths.x + 180) / 360, y)


def extents(paths: Paths, rows: int) -> np.ndarray:
    """The size of each row's shape: length of its lines, or the root of its area less holes.

    Of a shape of both, the larger one. Rings are closed whether or not they repeat their first position.
    """
    at, path = paths.segments()
    long = np.hypot(paths.x[at + 1] - paths.x[at], paths.y[at + 1] - paths.y[at])
    lines = paths.kind[path] == LINE
    length = np.bincount(paths.owner[path[lines]], long[lines], rows)
    # Twice the area of each ring, as seen from its first position.
    x0, y0 = paths.x[paths.first[path]], paths.y[paths.first[path]]
    cross = (paths.x[at] - x0) * (paths.y[at + 1] - y0) - (paths.x[at + 1] - x0) * (paths.y[at] - y0)
    ring = np.abs(np.bincount(path, cross, len(paths.owner))) / 2
    signed = np.where(paths.kind == AREA, np.where(paths.hole, -ring, ring), 0.0)
    area = np.bincount(paths.owner, signed, rows)
    return np.maximum(length, np.sqrt(np.maximum(area, 0)))
