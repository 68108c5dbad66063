"""Releases: ``theme=<theme>/type=<type>/*.parquet`` below a root."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mapsheaf.functions.curve import place_on_curve
from mapsheaf.functions.predicates import meets_box
from mapsheaf.model import TYPE_THEME, theme_types


def union_types(frames: list[DataFrame]) -> DataFrame:
    """All rows in one frame; columns are matched by name, missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_release(spark: SparkSession, root: str, theme: str | None = None,
                 type: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """Features of a release with their source file.

    Only the folders of the theme and type asked for are listed. Columns of the
    files are unified by name; that reads the footer of every file listed, so pass
    ``schema`` where it is known: then no footer is read to plan the scan.
    """
    if type is not None and theme is None:
        theme = TYPE_THEME[type]
    if type is not None and type not in theme_types(theme):
        raise ValueError(f"theme {theme} has no type {type}")
    path = root.rstrip("/")
    if theme is not None:
        path += f"/theme={theme}"
    if type is not None:
        path += f"/type={type}"
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return reader.parquet(path).withColumn("filename", F.col("_metadata.file_path"))


def scan_files(spark: SparkSession, root: str, paths: list[str],
               schema: StructType | str | None = None) -> DataFrame | None:
    """Features of the files named, each read once, and of no others; None without files.

    Nothing is listed. Folder names below ``root`` give theme and type.
    """
    if not paths:
        return None
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return reader.parquet(*sorted(set(paths))).withColumn("filename", F.col("_metadata.file_path"))


def clip_release(spark: SparkSession, root: str, out: str, theme: str, bbox=None,
                 cluster: bool = False, schema: StructType | str | None = None,
                 row_group_bytes: int | None = None) -> None:
    """Write the features of ``theme`` that meet ``bbox`` as a release below ``out``.

    Without a box everything is copied. Types without rows leave no folder. With
    ``cluster`` the rows are ordered along a Hilbert curve first, which costs a shuffle of
    the clipped rows and lets later boxes skip most row groups; the smaller those are
    (``row_group_bytes``), the closer their boxes.
    """
    theme_types(theme)
    df = scan_release(spark, root, theme, schema=schema).drop("filename", "theme")
    if bbox is not None:
        df = df.where(meets_box(bbox))
    if cluster:
        order = ["type", place_on_curve(), "id"]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = df.write if row_group_bytes is None else df.write.option("parquet.block.size", row_group_bytes)
    writer.mode("overwrite").partitionBy("type").parquet(f"{out}/theme={theme}")
