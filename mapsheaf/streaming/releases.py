"""New releases built once each, as they are announced; a job that may be ended at any moment.

Announcements are JSON files with ``release``, ``theme`` and ``path``, the rows of
``release_catalog``; whoever uploads a theme adds them after its last file. A streaming file source
hands them on in batches, and its checkpoint knows which it has seen. A batch that was not
committed comes again with the same number, so each step can be repeated:

1. what the record says is built is left out,
2. the themes of the batch are written by replacing their own folders only,
3. the record of the batch is written.

Below ``out``: ``tables/release=<r>/theme=<t>/`` and ``record/batch=<n>/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.model import THEME_TYPES

ANNOUNCEMENT = "release string, theme string, path string"
RECORD = "release string, theme string, latest boolean, batch int"
# Announcement files in one batch, so that a long backlog is built step by step.
BATCH_FILES = 1_000


def built(spark: SparkSession, out: str) -> DataFrame:
    """``release, theme, latest, batch`` of what is built; ``latest`` marks the newest release of all.

    Only releases in the record count: tables that a lost batch wrote do not.
    """
    record = spark.read.schema(RECORD).parquet(f"{out}/record")
    newest = record.agg(F.max("release")).scalar()
    return record.where("release is not null").withColumn("latest", F.col("release") == newest)


def built_tables(spark: SparkSession, out: str, schema=None) -> DataFrame | None:
    """Rows of all built themes with their ``release`` and ``theme``; None before the first."""
    done = built(spark, out)
    if done.isEmpty():
        return None
    reader = spark.read.option("basePath", f"{out}/tables")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    rows = reader.parquet(f"{out}/tables").withColumn("release", F.col("release").cast("string"))
    return rows.join(F.broadcast(done.select("release", "theme")), ["release", "theme"], "left_semi")


def _record(batch: DataFrame, out: str, number: int) -> None:
    """Say that the themes of a batch are built; the same batch replaces what it said before."""
    batch.select("release", "theme", F.lit(None).cast("boolean").alias("latest")).coalesce(1).write.mode(
        "overwrite").parquet(f"{out}/record/batch={number}")


def _build_batch(announced: DataFrame, number: int, root: str, out: str, build: Callable[[DataFrame], DataFrame]) -> None:
    spark = announced.sparkSession
    # At most BATCH_FILES announcement files; a theme announced twice is one.
    fresh = (
        announced.where(F.col("theme").isin(*THEME_TYPES) & F.col("release").isNotNull() & F.col("path").isNotNull())
        .groupBy("release", "theme").agg(F.min("path").alias("path"))
        .join(built(spark, out).select("release", "theme"), ["release", "theme"], "left_anti"))
    todo = fresh.collect()
    if not todo:
        return
    source = spark.read.option("basePath", root).option("mergeSchema", True).parquet(
        *sorted(f"{root.rstrip('/')}/{row.path}" for row in todo))
    named = source.withColumn("release", F.col("release").cast("string"))
    (
        build(named).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("release", "theme").parquet(f"{out}/tables")
    )
    _record(spark.createDataFrame(todo), out, number)


def build_releases(spark: SparkSession, announcements: str, root: str, out: str, checkpoint: str,
                   build: Callable[[DataFrame], DataFrame], batch_files: int = BATCH_FILES) -> int:
    """Build every theme announced so far that is not built yet; returns the number of batches run.

    ``root`` holds ``release=<r>/theme=<t>/`` folders; ``build`` gets the rows of a batch's themes
    and returns those to store, with ``release`` and ``theme``. Run it again after more was
    announced, or after it was ended: each theme is built once, a second run without news does nothing.
    """
    # So that the record can be read before the first batch; a row without release says nothing.
    spark.createDataFrame([(None, None, None)], "release string, theme string, latest boolean").coalesce(1).write.mode(
        "ignore").parquet(f"{out}/record/batch=-1")
    stream = (
        spark.readStream.schema(ANNOUNCEMENT).option("maxFilesPerTrigger", batch_files).json(announcements)
        .writeStream.foreachBatch(lambda batch, number: _build_batch(batch, number, root, out, build))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return len([p for p in stream.recentProgress if p.numInputRows])
