"""Manifests from the footers of parquet files, without reading rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.session import reliable_checkpoint, ship_package
from mapsheaf.sources.catalog import files_of, manifest_of
from mapsheaf.sources.release import scan_files

# Sides of a box with the statistic that bounds them.
_SIDES = {"xmin": min, "ymin": min, "xmax": max, "ymax": max}
FOOTER = "path string, rows long, row_groups int, xmin double, xmax double, ymin double, ymax double, known boolean"


def _read(path: str) -> dict:
    """Rows, row groups and box of one file; not ``known`` if the footer does not hold them or cannot be read."""
    row = dict.fromkeys([c.split()[0] for c in FOOTER.split(", ")]) | {"path": path, "known": False}
    try:
        # Spark writes local paths with one slash.
        store, name = fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and path[6] != "/" else path)
        with store.open_input_file(name) as file:
            footer = pq.ParquetFile(file).metadata
    except (OSError, pa.ArrowException):
        return row
    row |= {"rows": footer.num_rows, "row_groups": footer.num_row_groups}
    names = {footer.schema.column(n).path: n for n in range(footer.num_columns)}
    if any(f"bbox.{side}" not in names for side in _SIDES):
        return row
    for side, pick in _SIDES.items():
        bounds = []
        for group in range(footer.num_row_groups):
            column = footer.row_group(group).column(names[f"bbox.{side}"])
            statistics = column.statistics
            if statistics is None or not statistics.has_null_count:
                return row
            if statistics.null_count == column.num_values:
                continue
            if not statistics.has_min_max:
                return row
            bounds.append(statistics.min if pick is min else statistics.max)
        row[side] = float(pick(bounds)) if bounds else None
    return row | {"known": True}


def file_footers(spark: SparkSession, root: str) -> DataFrame:
    """One row per parquet file below ``root``, read off its footer by the task that has its path.

    Files in stores that only Spark can open come out as not ``known``.
    """
    ship_package(spark)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("path", pa.string()), ("rows", pa.int64()), ("row_groups", pa.int32()), *((s, pa.float64()) for s in (
                "xmin", "xmax", "ymin", "ymax")), ("known", pa.bool_())])
        for part in parts:
            yield pa.RecordBatch.from_pylist([_read(path) for path in part.column(0).to_pylist()], schema)

    # Only paths are asked for, so no content is read; they are dealt out evenly.
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(root).select("path")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(parts, "path").mapInArrow(batches, FOOTER)


def footer_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of a release, as ``file_manifest`` has it, from footers.

    Only files whose footers do not bound their boxes are scanned; the driver holds their names,
    as any scan of them does.
    """
    footers = reliable_checkpoint(file_footers(spark, root))
    folder = F.split("path", "/")
    box = F.struct(*(F.col(side) for side in ("xmin", "xmax", "ymin", "ymax"))).alias("bbox")
    named = footers.where("known and rows > 0").select(
        F.substring_index(F.element_at(folder, -3), "=", -1).alias("theme"),
        F.substring_index(F.element_at(folder, -2), "=", -1).alias("type"),
        F.col("path").alias("filename"), box, F.col("rows").alias("features"))
    rest = [r.path for r in footers.where("not known").select("path").collect()]
    scanned = scan_files(spark, root, rest)
    return manifest_of(named if scanned is None else named.unionByName(files_of(scanned)), root)
