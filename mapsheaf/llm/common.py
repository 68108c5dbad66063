"""Shared pieces: tables, ids, blobs, what a worker keeps, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.session import new_dir, ship_package

# Fixed value: a word is a run of characters other than space and U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages read files instead of recomputing the lineage, so a lost executor
    neither repeats the work nor changes rows.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Keys are broadcast up to this many, counted first; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def without(df: DataFrame, column: Column, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is none of ``keys``, a table that is written already.

    Few keys go to the rows, so that whole texts are not shuffled.
    """
    keys = keys.select(F.col(key).alias("__key"))
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.withColumn("__own_key", column).join(
        keys, F.col("__own_key") == F.col("__key"), "left_anti").select(df.columns)


# What this worker process keeps between tasks: of one operator at a time.
_kept: dict[Hashable, object] = {}


def give_back() -> None:
    """Return memory that a task has freed to the system, as workers live on after it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def keep_only(key: Hashable = None, make: Callable[[], object] | None = None) -> object:
    """What is kept under ``key``, made if need be; all else is dropped, without ``make`` everything."""
    for other in [k for k in _kept if make is None or k != key]:
        del _kept[other]
        give_back()
    if make is not None and key not in _kept:
        _kept[key] = make()
    return _kept.get(key)


def hash_fold(column: Column, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; null when the value is null."""
    return F.crc32(column.cast("string")) % folds


def components(links: DataFrame, low: str, high: str) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node with a link.

    Alternating stars: each round hangs a node's larger neighbours, then its smaller
    ones, below the smallest neighbour. Rounds grow with the logarithm of the longest
    path. Minima are combined before the shuffle; every round is written to the shared
    folder. Self links and repeated links do no harm.
    """
    edges = materialize(
        links.select(F.col(low).alias("u"), F.col(high).alias("v")).where("u <> v").distinct(),
        "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Every edge now runs from the larger node to a smaller one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("a"), "m").where("a <> m")
                 .union(least.select("u", "m")))
        edges = materialize(small.toDF("u", "v").distinct(), "links")
    nodes = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node")).distinct()
    return nodes.union(roots.select("node", F.col("node").alias("component")))
