"""Near-duplicate vectors by 8-bit tile products with rigorous error bounds.

Vectors of one label are dealt into blocks; every two blocks meet in one tile. A tile
multiplies quantised vectors, adds the largest error that quantising can have made to
each product, and recomputes in double precision only what may still reach the
threshold. It returns sums and a spanning forest, never the pairs.

Rows whose label or vector is null, or whose vector is empty, zero or holds a null or
non-finite component, link with nothing. Vectors of different lengths do not link. Equal
vectors are one class, however many rows it has. Repeated ids count as rows of their own.
Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapsheaf.llm.common import components, materialize

BLOCK_ROWS = 2048
STRIP_ROWS = 512
ROUNDING = 1e-9


def _usable(vector: list | None) -> bytes | None:
    """The vector as doubles, scaled by a power of two so that squares neither over- nor underflow."""
    if not vector or any(x is None for x in vector):
        return None
    values = np.asarray(vector, np.float64)
    top = np.abs(values).max()
    if not np.isfinite(values).all() or top == 0:
        return None
    return (np.ldexp(values, -int(np.frexp(top)[1])) + 0.0).tobytes()


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes from -127 to 127 of unit vectors, their scale, and the length of what is lost."""
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    codes = np.rint(unit / scale)
    lost = np.linalg.norm(unit - codes * scale, axis=1)
    return codes.astype(np.int8), scale[:, 0], lost


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of unit vectors whose product reaches ``threshold``, a strip of rows at a time."""
    codes, scale, lost = quantise(left)
    other, other_scale, other_lost = quantise(right)
    # Products of codes are whole numbers below 2^24 for up to 1,040 components, exact in single precision.
    kind = np.float32 if left.shape[1] <= 1040 else np.float64
    other = np.ascontiguousarray(other.T.astype(kind))
    for start in range(0, len(left), STRIP_ROWS):
        rows = slice(start, start + STRIP_ROWS)
        about = (codes[rows].astype(kind) @ other) * (scale[rows, None] * other_scale)
        # |u.v - û.v̂| <= |û| |v - v̂| + |u - û| |v|, and |û| <= 1 + |u - û|.
        bound = (1 + lost[rows, None]) * other_lost + lost[rows, None] + ROUNDING
        a, b = np.nonzero(about + bound >= threshold)
        for k in range(0, len(a), 1 << 16):
            x, y = a[k:k + (1 << 16)] + start, b[k:k + (1 << 16)]
            hit = np.einsum("ij,ij->i", left[x], right[y]) >= threshold
            yield x[hit], y[hit]


def _forest(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """The smallest row reachable from each row."""
    label = np.arange(size)
    while True:
        before = label.copy()
        low = np.minimum(label[first], label[second])
        np.minimum.at(label, first, low)
        np.minimum.at(label, second, low)
        label = label[label]
        if (label == before).all():
            return label


def _tile(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    frame = frame.sort_values("rep", ignore_index=True)
    side = frame["side"].to_numpy()
    vectors = np.stack([np.frombuffer(v, np.float64) for v in frame["vector"]])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rows, reps = frame["rows"].to_numpy(), frame["rep"].to_numpy()
    own = frame["low"].iloc[0] == frame["high"].iloc[0]
    first = np.arange(len(frame)) if own else np.flatnonzero(side == 0)
    second = first if own else np.flatnonzero(side == 1)
    near = np.zeros(len(frame), np.int64)
    root = np.arange(len(frame))
    if len(first) and len(second):
        for x, y in linked_pairs(unit[first], unit[second], threshold):
            x, y = first[x], second[y]
            if own:
                x, y = x[x < y], y[x < y]
            np.add.at(near, x, rows[y])
            np.add.at(near, y, rows[x])
            tied = _forest(root[x], root[y], len(frame))
            root = tied[root]
    kept = near > 0
    return pd.DataFrame({
        "label": frame["label"][kept], "digest": frame["digest"][kept], "rep": reps[kept],
        "near": near[kept], "root": reps[root[kept]]})


def embedding_groups(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    def prepared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            usable = [_usable(v) for v in part.column(2).to_pylist()]
            label = [k if v else None for k, v in zip(part.column(1).to_pylist(), usable, strict=True)]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(label, pa.string()), pa.array(usable, pa.binary()),
                pa.array([v and md5(v).digest() for v in usable], pa.binary())],
                ["vec_id", "label", "vector", "digest"])

    narrow = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    rows = materialize(
        narrow.mapInArrow(prepared, "vec_id long, label string, vector binary, digest binary"), "vectors")
    whole = rows.where("label is not null and vec_id is not null").withColumn("size", F.length("vector"))
    classes = whole.groupBy("label", "size", "digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("rows"), F.min("vector").alias("vector"))
    classes = materialize(classes, "vector-classes")
    blocks = classes.groupBy("label", "size").agg(
        F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("digest"), "blocks").cast("int")
    tiles = (
        classes.join(blocks, ["label", "size"]).withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "size", "digest", "rep", "rows", "vector",
                F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                (F.col("block") > F.col("other")).cast("int").alias("side")))
    found = materialize(
        tiles.groupBy("label", "size", "low", "high").applyInPandas(
            lambda frame: _tile(frame, threshold), "label string, digest binary, rep long, near long, root long"), "tiles")
    near = found.groupBy("label", "digest").agg(F.sum("near").alias("near"))
    tied = components(found, "rep", "root")
    classes = (
        classes.select("label", "digest", "rep", "rows")
        .join(near, ["label", "digest"], "left").join(tied, F.col("rep") == F.col("node"), "left")
        .select("label", "digest", (F.col("rows") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")))
    single = rows.where("label is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    joined = rows.where("label is not null and vec_id is not null").join(classes, ["label", "digest"])
    return joined.select("vec_id", "n_links", "component_id").union(single).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
