"""File manifests, release catalogs and the files a download needs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.functions.predicates import meets_box
from mapsheaf.model import THEME_TYPES, Box
from mapsheaf.operators.joins import box_join, numbered
from mapsheaf.operators.views import view_extract
from mapsheaf.session import reliable_checkpoint
from mapsheaf.sources.release import scan_files, scan_release

# Files that are named one by one for a scan; for more, folders are listed and rows matched by file.
LISTED_FILES = 100_000


def files_of(features: DataFrame) -> DataFrame:
    """One row per file of a scanned release: rows, and the box they really cover.

    A file with a feature across 180 degrees (west beyond east) reaches around the world.
    """
    crosses = F.col("bbox.xmin") > F.col("bbox.xmax")
    return features.groupBy("theme", "type", "filename").agg(
        F.struct(
            F.min(F.when(crosses, -180.0).otherwise(F.col("bbox.xmin"))).alias("xmin"),
            F.max(F.when(crosses, 180.0).otherwise(F.col("bbox.xmax"))).alias("xmax"),
            F.min("bbox.ymin").alias("ymin"), F.max("bbox.ymax").alias("ymax"),
        ).alias("bbox"),
        F.count("*").alias("features"),
    )


def manifest_of(files: DataFrame, root: str) -> DataFrame:
    """Files numbered over all themes in path order; the number is part of the id."""
    tail = F.concat(
        F.lit("theme="), F.col("theme"), F.lit("/type="), F.col("type"), F.lit("/"),
        F.substring_index("filename", "/", -1))
    listed = numbered(files.withColumn("rel_path", tail), ["rel_path"], "file_no")
    return listed.select(
        F.concat_ws("-", "type", "file_no").alias("file_id"), "file_no", "theme", "type",
        "rel_path", F.concat(F.lit(root.rstrip("/") + "/"), F.col("rel_path")).alias("path"),
        "bbox", "features")


def file_manifest(features: DataFrame, root: str) -> DataFrame:
    """One row per file of a scanned release with the box its features really cover.

    Reads the box columns only; ``footer_manifest`` reads footers instead. Files are numbered
    over all themes in path order, and the number is part of the id.
    """
    return manifest_of(files_of(features), root)


def release_catalog(tiles: DataFrame, releases: DataFrame) -> DataFrame:
    """Release and theme rows for the themes that have tiles; the newest release is latest.

    ``tiles`` has ``release`` and ``theme``, ``releases`` has ``release``.
    """
    themes = F.array(*(F.lit(theme) for theme in THEME_TYPES))
    wanted = releases.select("release").distinct().withColumn("theme", F.explode(themes))
    present = tiles.select("release", "theme").distinct()
    newest = releases.agg(F.max("release")).scalar()
    return wanted.join(present, ["release", "theme"], "left_semi").select(
        "release", "theme", (F.col("release") == newest).alias("latest"),
        F.concat_ws("/", "release", "theme").alias("path"))


def latest_release(catalog: DataFrame, seen: DataFrame) -> DataFrame:
    """Themes of the release flagged latest; empty when it was already processed."""
    return catalog.where("latest").join(seen.select("release"), "release", "left_anti")


def download_catalog(manifest: DataFrame, requests: DataFrame, hint: str | None = None) -> DataFrame:
    """Files to read for each request, in file order; types without files vanish.

    ``requests`` has ``request_id``, ``type`` and ``box``. A file counts if its box
    overlaps the request's; touching is not enough.
    """
    pairs = box_join(manifest, requests, on=("type",), closed=False, hint=hint)
    return pairs.select("request_id", "type", "file_no", "rel_path").orderBy(
        "request_id", "type", "file_no")


def download_extract(spark: SparkSession, manifest: DataFrame, root: str, bbox, types: Iterable[str]) -> DataFrame | None:
    """Features of ``types`` that meet ``bbox``, out of the files that the manifest names for it.

    The driver holds the names of the files of this one request, as any scan of them does.
    None if no file overlaps the box.
    """
    box = Box.of(bbox)
    sides = F.struct(*(F.lit(float(side)).alias(name) for name, side in (
        ("xmin", box.west), ("xmax", box.east), ("ymin", box.south), ("ymax", box.north))))
    requests = spark.createDataFrame([(type_,) for type_ in types], "type string").select(
        F.lit(0).alias("request_id"), "type", sides.alias("box"))
    chosen = download_catalog(manifest, requests).select("rel_path").collect()
    found = scan_files(spark, root, [f"{root.rstrip('/')}/{row.rel_path}" for row in chosen])
    return None if found is None else found.where(meets_box(box))


def view_files(manifest: DataFrame, views: DataFrame, choices: DataFrame | None = None,
               hint: str | None = None) -> DataFrame:
    """``view_id, box, rel_path`` for every file whose box meets a view's; touching is enough.

    With ``choices`` (``view_id, types``) only files of the view's own types. Works on files
    and views alone, so a release of any size costs what its manifest costs.
    """
    pairs = view_extract(manifest.select("type", "rel_path", "bbox"), views.select("view_id", "box"), choices, hint)
    return pairs.select("view_id", "box", "rel_path")


def extract_views(spark: SparkSession, manifest: DataFrame, root: str, views: DataFrame,
                  choices: DataFrame | None = None, schema=None, hint: str | None = None,
                  listed_files: int = LISTED_FILES) -> DataFrame | None:
    """``view_extract`` over a release on disk that reads each file some view needs once, and no other.

    Files and views are matched first; only the names of the files are kept of that, written down, as they decide
    what is read. Rows then meet views by place: one row for each file a view meets would be many. Up to
    ``listed_files`` files are named by the driver; beyond that, counted first, the folders of the
    types needed are listed by Spark and rows of other files fall out in a join. None if no file meets a view.
    """
    # Names are combined in each task before they are shuffled.
    chosen = reliable_checkpoint(view_files(manifest, views, choices, hint).select("rel_path").distinct())
    path = root.rstrip("/")
    if chosen.count() <= listed_files:
        rows = scan_files(spark, root, [f"{path}/{row.rel_path}" for row in chosen.collect()], schema)
    else:
        # At most one folder for each type of a release.
        folders = chosen.select(F.substring_index("rel_path", "/", 2).alias("folder")).distinct().collect()
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (
            scan_release(spark, root, *(part.split("=", 1)[1] for part in row.folder.split("/")), schema) for row in folders))
        rows = rows.withColumn("rel_path", F.concat_ws("/", F.slice(F.split("filename", "/"), -3, 3))).join(
            chosen, "rel_path", "left_semi").drop("rel_path")
    if rows is None:
        return None
    return view_extract(rows, views.select("view_id", "box"), choices, hint)
