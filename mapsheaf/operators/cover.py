"""Shapes on the map: the tiles they really cover, and how large they are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapsheaf.functions.shapes import AREA, Paths, decode, extents, to_world
from mapsheaf.operators.tiling import ROW_TILES, many_tiles, zoom_bounds
from mapsheaf.session import ship_package

# Tile rows of one output batch, about.
BATCH_ROWS = 1 << 17


def geometry_extent(geometry: str = "geometry") -> Column:
    """Size of a well-known binary shape as a part of the width of the Mercator world.

    The length of lines, the square root of areas without their holes; 0 for points, null for what
    is null or cannot be read. Worth storing beside the box, see ``with_extent``.
    """
    @F.arrow_udf(T.DoubleType())
    def extent(shapes: pa.Array) -> pa.Array:
        paths = to_world(decode(shapes))
        known = np.zeros(len(shapes), bool)
        known[paths.owner] = True
        return pa.array(extents(paths, len(shapes)), mask=~known)

    return extent(F.col(geometry))


def with_extent(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Add ``extent``, by which ``min_pixel_filter`` and ``attribute_visibility`` judge size."""
    ship_package(df.sparkSession)
    return df.withColumn("extent", geometry_extent(geometry))


def _expanded(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers from ``first`` to ``last``, and which pair each is of."""
    sizes = np.maximum(last - first + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner], owner


def _merged(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each row that overlap or touch made one."""
    order = np.lexsort((high, low, row))
    row, low, high = row[order], low[order], high[order]
    if not len(row):
        return row, low, high
    # The furthest end so far in the same row: rows are kept apart by a wide step.
    step = int(high.max()) + 3
    number = np.cumsum(np.diff(row, prepend=row[0]) != 0)
    reach = np.maximum.accumulate(number * step + high)
    fresh = np.ones(len(row), bool)
    fresh[1:] = number[1:] * step + low[1:] > reach[:-1] + 1
    begin = np.flatnonzero(fresh)
    return row[begin], low[begin], (reach - number * step)[np.append(begin[1:], len(row)) - 1]


def cover(paths: Paths, zoom: int, wrapped: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``owner, y, x0, x1``: tile rows and the columns in them that the shapes meet, each tile once.

    ``paths`` are in world coordinates. Lines are followed through the rows they pass; areas add
    what lies between crossings of the middle of a row, holes left out: a tile no edge
    meets is inside or outside as a whole. Rows that are ``wrapped`` cross 180 degrees; their eastern part
    follows on the western, and columns beyond the edge come round again.
    """
    tiles = 1 << zoom
    x, y = paths.x * tiles, paths.y * tiles
    shifted = wrapped[paths.owner[np.repeat(np.arange(len(paths.owner)), np.diff(paths.first))]] & (paths.x < 0.5)
    x = np.where(shifted, x + tiles, x)
    at, path = paths.segments()
    alone = paths.first[:-1][np.diff(paths.first) == 1]
    lone = np.flatnonzero(np.diff(paths.first) == 1)
    x0, y0 = np.concatenate([x[at], x[alone]]), np.concatenate([y[at], y[alone]])
    x1, y1 = np.concatenate([x[at + 1], x[alone]]), np.concatenate([y[at + 1], y[alone]])
    path = np.concatenate([path, lone])
    owner = paths.owner[path]
    top, bottom = np.minimum(y0, y1), np.maximum(y0, y1)

    def column_at(which: np.ndarray, height: np.ndarray) -> np.ndarray:
        rise = y1[which] - y0[which]
        flat = rise == 0
        return np.where(flat, x0[which], x0[which] + (height - y0[which]) / np.where(flat, 1, rise) * (x1[which] - x0[which]))

    row, edge = _expanded(np.floor(top).astype(np.int64), np.floor(bottom).astype(np.int64))
    level = y0[edge] == y1[edge]
    first = column_at(edge, np.maximum(top[edge], row))
    last = np.where(level, x1[edge], column_at(edge, np.minimum(bottom[edge], row + 1)))
    first = np.where(level, x0[edge], first)
    spans = [(owner[edge], row, np.minimum(first, last), np.maximum(first, last))]

    # Crossings of the middles of rows, in pairs from the west.
    ring = np.flatnonzero((paths.kind[path] == AREA) & (top < bottom))
    middle, crossing = _expanded(np.ceil(top[ring] - 0.5).astype(np.int64), np.ceil(bottom[ring] - 0.5).astype(np.int64) - 1)
    crossing = ring[crossing]
    where = column_at(crossing, middle + 0.5)
    order = np.lexsort((where, middle, owner[crossing]))
    west, east = order[::2], order[1::2]
    west = west[:len(east)]
    spans.append((owner[crossing[west]], middle[west], where[west], where[east]))

    owner, row, low, high = (np.concatenate(part) for part in zip(*spans, strict=True))
    row = np.clip(row, 0, tiles - 1)
    low, high = np.floor(low).astype(np.int64), np.floor(high).astype(np.int64)
    wrap = wrapped[owner]
    low, high = np.where(wrap, low, np.clip(low, 0, tiles - 1)), np.where(wrap, high, np.clip(high, 0, tiles - 1))
    beyond = wrap & (high >= tiles)
    inside = ~beyond | (low < tiles)
    owner = np.concatenate([owner[inside], owner[beyond]])
    row = np.concatenate([row[inside], row[beyond]])
    ends = np.concatenate([np.minimum(high[inside], tiles - 1), np.minimum(high[beyond] - tiles, tiles - 1)])
    low = np.concatenate([low[inside], np.maximum(low[beyond] - tiles, 0)])
    key, low, ends = _merged(owner * tiles + row, low, ends)
    return key // tiles, key % tiles, low, ends


def _extremes(paths: Paths, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Western, eastern, northern and southern side of the features whose paths begin at ``first``."""
    at = paths.first[first]
    return (np.minimum.reduceat(paths.x, at), np.maximum.reduceat(paths.x, at),
            np.minimum.reduceat(paths.y, at), np.maximum.reduceat(paths.y, at))


def _tile_runs(paths: Paths, first: np.ndarray, last: np.ndarray, wrapped: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``owner, z, y, x0, x1`` by owner, for some features at a time: about ``BATCH_ROWS`` tile rows.

    A shape with all its positions on one tile is on no other; only what spans several is followed.
    """
    of = np.searchsorted(paths.owner, np.arange(len(first) + 1))
    shown = np.flatnonzero(np.diff(of))
    if not len(shown):
        return
    west, east, north, south = _extremes(paths, of[shown])
    first, last = first[shown], last[shown]
    work = np.cumsum((south - north) * (2.0 ** (last + 1) - 2.0 ** first) + last - first + 1)
    begin = 0
    while begin < len(shown):
        done = work[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(work, done + BATCH_ROWS, "right")))
        some, here = slice(begin, end), shown[begin:end]
        a, b = of[here[0]], of[here[-1] + 1]
        found = []
        for zoom in range(int(first[some].min()), int(last[some].max()) + 1):
            tiles = 1 << zoom
            active = (first[some] <= zoom) & (zoom <= last[some])
            column, row = np.floor(west[some] * tiles), np.floor(north[some] * tiles)
            single = (column == np.floor(east[some] * tiles)) & (row == np.floor(south[some] * tiles)) & ~wrapped[here]
            alone = active & single
            column, row = (np.clip(v[alone], 0, tiles - 1).astype(np.int64) for v in (column, row))
            found.append((here[alone], np.full(len(row), zoom), row, column, column))
            follow = np.zeros(len(wrapped), bool)
            follow[here[active & ~single]] = True
            use = follow[paths.owner[a:b]]
            if use.any():
                sizes = np.diff(paths.first[a:b + 1])
                points = np.repeat(use, sizes)
                owner, y, x0, x1 = cover(Paths(
                    paths.owner[a:b][use], paths.kind[a:b][use], paths.hole[a:b][use],
                    np.concatenate([[0], np.cumsum(sizes[use])]),
                    paths.x[paths.first[a]:paths.first[b]][points], paths.y[paths.first[a]:paths.first[b]][points]), zoom, wrapped)
                found.append((owner, np.full(len(y), zoom), y, x0, x1))
        begin = end
        values = [np.concatenate(part) for part in zip(*found, strict=True)]
        if len(values[0]):
            order = np.argsort(values[0], kind="stable")
            yield tuple(v[order] for v in values)


def tile_cover(df: DataFrame, zmin: int = 0, zmax: int = 14, geometry: str = "geometry") -> DataFrame:
    """One row per feature and tile its shape meets, between its first and last zoom.

    Features are dealt out to all tasks. Each becomes rows that hold runs of neighbouring tiles; those of a
    feature whose box is on ``ROW_TILES`` tiles at most are expanded where they are. Runs of others
    are dealt out again, at most ``ROW_TILES`` tiles in each, and only there expanded. Shapes are taken in Mercator, straight
    between their positions. Features whose box has west beyond east cross 180
    degrees. A feature without a readable shape is on no tile.
    """
    ship_package(df.sparkSession)
    bounded = zoom_bounds(df, zmin, zmax).withColumn("_wrapped", F.coalesce(F.col("bbox.xmin") > F.col("bbox.xmax"), F.lit(False)))
    kept = [c for c in df.columns if c != geometry]
    run = T.StructType([T.StructField(c, T.IntegerType()) for c in ("z", "y", "_x0", "_x1")])
    listed = T.StructType([*bounded.select(kept).schema.fields, T.StructField("_runs", T.ArrayType(run))])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            paths = to_world(decode(part.column(part.schema.get_field_index("_shape"))))
            wrapped = np.asarray(part.column(part.schema.get_field_index("_wrapped")))
            first, last = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("_first", "_last"))
            for owner, *values in _tile_runs(paths, first, last, wrapped):
                # A row for each feature, or for each ROW_TILES of its runs.
                place = np.arange(len(owner)) - np.searchsorted(owner, owner)
                begins = np.flatnonzero(place % ROW_TILES == 0)
                runs = pa.StructArray.from_arrays([pa.array(v.astype(np.int32)) for v in values], run.names)
                offsets = pa.array(np.append(begins, len(owner)).astype(np.int32))
                own = part.select(kept).take(pa.array(owner[begins]))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.ListArray.from_arrays(offsets, runs)], [*kept, "_runs"])

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def found(features: DataFrame) -> DataFrame:
        # The box beside the id, so that features with one id, or none, are not dealt to one task.
        dealt = features.repartition(parts, "id", "bbox.xmin", "bbox.ymin")
        return dealt.select(*kept, F.col(geometry).alias("_shape"), "_first", "_last", "_wrapped").mapInArrow(
            batches, listed).select(*kept, F.inline("_runs"))

    many = many_tiles(ROW_TILES)
    near = found(bounded.where(~many)).withColumn("x", F.explode(F.sequence("_x0", "_x1")))
    far = (
        found(bounded.where(many))
        .withColumn("_xa", F.explode(F.sequence("_x0", "_x1", F.lit(ROW_TILES))))
        .repartition(parts, "id", "z", "y", "_xa")
        .withColumn("x", F.explode(F.sequence("_xa", F.least(F.col("_x1"), F.col("_xa") + ROW_TILES - 1))))
        .drop("_xa")
    )
    return near.unionByName(far).drop("_x0", "_x1")
