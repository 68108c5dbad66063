"""Shards by vector bin packing: bytes, tokens and rows are balanced jointly.

Equal texts are a group and share a shard, unless the group alone is more than a shard's
share; then it is cut into as few pieces as fit. Groups go, largest first, to the shard
whose residual capacity has the highest dot product with the group's sizes.

Groups of at least one part in ``LARGE`` of a shard are placed first. There are at most
3 * shards * LARGE of them, whatever the input, so they are placed on the driver and
broadcast. The rest is dealt by hash into buckets; each is packed in a task of its own
against its share of what the large groups left.

A null text is a group of its own, of size 1 and checksum 0; null ids are ordinary rows.
Repeated rows each get a slot. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapsheaf.llm.common import WORD_PATTERN, materialize

SIZES = ("bytes", "tokens", "rows")
LARGE = 64
BUCKET_GROUPS = 50_000
SLICE_ROWS = 50_000


def place(sizes: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """The shard of each group; ``residual`` (shards by sizes) is used up.

    Both are in shares of a shard's capacity. Ties go to the first shard.
    """
    shard = np.empty(len(sizes), np.int32)
    for n in np.argsort(-sizes.max(axis=1, initial=0), kind="stable"):
        best = int(np.argmax(residual @ sizes[n]))
        residual[best] -= sizes[n]
        shard[n] = best
    return shard


def _shares(frame: pd.DataFrame, capacity: np.ndarray) -> np.ndarray:
    return frame[list(SIZES)].to_numpy(np.float64) / capacity


def pack(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, n_tokens`` for every row."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce(F.unhex(F.md5(text)), F.lit(b"")).alias("key")), "sized")
    groups = materialize(rows.groupBy("key").agg(
        F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")), "groups")
    totals = groups.agg(*(F.sum(s).alias(s) for s in SIZES), F.count("*").alias("groups")).first()
    capacity = np.array([max(totals[s] or 0, 1) / shards for s in SIZES])
    is_large = F.lit(False)
    for size, most in zip(SIZES, capacity, strict=True):
        is_large |= F.col(size) >= float(most / LARGE)

    large = groups.where(is_large).toPandas().sort_values("key", ignore_index=True)
    pieces = np.ceil(_shares(large, capacity).max(axis=1, initial=0)).clip(1).astype(int)
    large = large.loc[np.repeat(np.arange(len(large)), pieces)].assign(
        piece=[p for n in pieces for p in range(n)], pieces=np.repeat(pieces, pieces))
    sizes = _shares(large, capacity) / large["pieces"].to_numpy()[:, None]
    residual = np.ones((shards, len(SIZES)))
    placed = place(sizes, residual)
    left = residual.sum(axis=0)

    def bucket(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key", ignore_index=True)
        sizes = _shares(frame, capacity)
        turn = int(frame["bucket"].iloc[0]) % shards  # ties start elsewhere in each bucket
        own = np.roll(residual, -turn, axis=0) * (sizes.sum(axis=0) / np.where(left > 0, left, 1))
        return pd.DataFrame({"key": frame["key"], "shard": (place(sizes, own) + turn) % shards})

    count = totals["groups"] or 1
    buckets = max(math.ceil(count / BUCKET_GROUPS), min(32, math.ceil(count / 2000)))
    small = groups.where(~is_large).withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    small = small.groupBy("bucket").applyInPandas(bucket, "key binary, shard int")

    whole = spark.createDataFrame(
        [(bytes(k), int(p), int(n), int(s)) for k, p, n, s in zip(
            large["key"], large["piece"], large["pieces"], placed, strict=True)],
        "key binary, piece int, pieces int, shard int")
    counts = F.broadcast(whole.select("key", "pieces").distinct())
    in_large = rows.join(counts, "key").withColumn(
        "piece", F.pmod(F.xxhash64("doc_id"), "pieces").cast("int"))
    columns = ["doc_id", "size", "text_crc32", "n_tokens", "shard"]
    dealt = in_large.join(F.broadcast(whole.drop("pieces")), ["key", "piece"]).select(columns).union(
        rows.join(counts, "key", "left_anti").join(small, "key").select(columns))

    # Slots without one task per shard: number the rows of each slice, then add what lies before.
    slices = max(32, math.ceil((totals["rows"] or 0) / SLICE_ROWS))
    dealt = materialize(dealt.withColumn(
        "slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int")), "dealt")
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "slice").count().select(
        "shard", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")
    numbered = dealt.withColumn("n", F.row_number().over(within) - 1).join(offsets, ["shard", "slice"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("n")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "n_tokens")
