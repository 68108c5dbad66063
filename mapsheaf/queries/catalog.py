"""Releases on disk, manifests, catalogs and extracts."""

from __future__ import annotations

import struct
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapsheaf.model import THEME_TYPES
from mapsheaf.operators import views as view_op
from mapsheaf.queries.filters import REGION
from mapsheaf.queries.fixture import VIEW_SQL, features, sql, table, views
from mapsheaf.queries.registry import query
from mapsheaf.session import new_dir, write_in_order
from mapsheaf.sources import catalog as op
from mapsheaf.sources import export, footers, geojson, release
from mapsheaf.streaming import releases as stream

# Columns written for each theme, so that files of a release differ in schema.
RELEASE_COLUMNS = {
    "addresses": ("number", "unit", "street"),
    "base": ("subtype", "class", "names", "depth", "is_intermittent", "cartography"),
    "buildings": ("subtype", "height", "min_height", "has_parts"),
    "divisions": ("subtype", "class", "names", "population"),
    "places": ("names", "categories", "confidence"),
    "transportation": ("subtype", "class", "subclass", "names"),
}

_written: dict[tuple[str, str], str] = {}


def release_root(spark, sf_dir: str) -> str:
    """Where the features lie as a release; written once per session and input."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _written:
        root = new_dir(spark, "release")
        for theme, columns in RELEASE_COLUMNS.items():
            frame = features(spark, sf_dir, theme).select(
                "type", "id", "key", "geom_type", "bbox", "sources", "version", *columns)
            # A theme has few types, so rows go to their folders as they come, without being sorted by type.
            write_in_order(frame, f"{root}/theme={theme}", "type", "zstd")
        _written[known] = root
    return _written[known]


@query("scan_release", sql(
    """SELECT id, theme, type, subtype, class, depth, confidence, number,
      'theme=' || theme || '/type=' || type AS folder FROM features"""))
def scan_release(spark, sf_dir):
    rows = release.scan_release(spark, release_root(spark, sf_dir))
    folder = F.concat_ws("/", F.slice(F.split("filename", "/"), -3, 2))
    return rows.select(
        "id", "theme", "type", "subtype", "class", "depth", "confidence", "number", folder.alias("folder"))


@query("union_types", sql(
    "SELECT id, type, subtype, class, number, confidence, height, population FROM features"))
def union_types(spark, sf_dir):
    # Each theme brings some of the columns.
    columns = {
        "addresses": ("number",), "base": ("subtype", "class"), "buildings": ("subtype", "height"),
        "divisions": ("subtype", "class", "population"), "places": ("confidence",),
        "transportation": ("subtype", "class"),
    }
    return release.union_types([
        features(spark, sf_dir, theme).select("id", "type", *own) for theme, own in columns.items()])


_CLIP = "xmin <= 35.91 AND xmax >= -10 AND ymin <= 60 AND ymax >= 29.45"


@query("clip_release", sql(
    f"""SELECT id, theme, type, subtype, class FROM features
    WHERE theme IN ('base', 'places', 'buildings', 'addresses') AND {_CLIP}
    UNION ALL SELECT id, theme, type, subtype, class FROM features WHERE theme IN ('transportation', 'divisions')"""))
def clip_release(spark, sf_dir):
    # All six themes: four are clipped, two copied whole.
    root, out = release_root(spark, sf_dir), new_dir(spark, "clip")
    for theme in RELEASE_COLUMNS:
        box = None if theme in ("transportation", "divisions") else REGION
        release.clip_release(spark, root, out, theme, box, cluster=theme == "base")
    return release.scan_release(spark, out).select("id", "theme", "type", "subtype", "class")


# Files that hold the features of ten by ten degrees each, named after their cell.
_CELL = "lpad(CAST(CAST(floor((xmin + 180) / 10) AS INT) AS STRING), 2, '0') || lpad(CAST(CAST(floor((ymin + 90) / 10) AS INT) AS STRING), 2, '0')"
_MANIFEST_SQL = f"""files AS (
  SELECT theme, type, 'theme=' || theme || '/type=' || type || '/' || {_CELL} || '.parquet' AS rel_path,
    min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, count(*) AS features
  FROM features GROUP BY ALL),
manifest AS (SELECT *, row_number() OVER (ORDER BY rel_path) - 1 AS file_no FROM files)"""


def manifest(spark, sf_dir):
    """The manifest of a release whose files hold ten by ten degrees each."""
    rows = features(spark, sf_dir).select("theme", "type", "bbox", "bbox.xmin", "bbox.ymin")
    placed = rows.withColumn("filename", F.concat(
        F.lit("/release/theme="), "theme", F.lit("/type="), "type", F.lit("/"), F.expr(_CELL), F.lit(".parquet")))
    return op.file_manifest(placed, "/release")


@query("file_manifest", sql(
    """SELECT type || '-' || file_no AS file_id, file_no, theme, type, rel_path, '/release/' || rel_path AS path,
      xmin, ymin, xmax, ymax, features FROM manifest""", _MANIFEST_SQL))
def file_manifest(spark, sf_dir):
    return manifest(spark, sf_dir).select(
        "file_id", "file_no", "theme", "type", "rel_path", "path", "bbox.xmin", "bbox.ymin", "bbox.xmax",
        "bbox.ymax", "features")


_BY_TYPE = """SELECT theme, type, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax,
      count(*) AS features, TRUE AS numbered FROM features GROUP BY theme, type"""


def _by_type(files):
    # Which files there are depends on the writer; what they hold together, and that
    # their numbers run from 0 without gaps, does not.
    whole = files.agg(
        ((F.min("file_no") == 0) & (F.max("file_no") + 1 == F.count("*"))
         & (F.count_distinct("file_no") == F.count("*"))).alias("numbered")).scalar()
    return files.groupBy("theme", "type").agg(
        F.min("bbox.xmin").alias("xmin"), F.min("bbox.ymin").alias("ymin"), F.max("bbox.xmax").alias("xmax"),
        F.max("bbox.ymax").alias("ymax"), F.sum("features").alias("features")).withColumn("numbered", whole)


@query("file_manifest_scanned", sql(_BY_TYPE))
def file_manifest_scanned(spark, sf_dir):
    root = release_root(spark, sf_dir)
    return _by_type(op.file_manifest(release.scan_release(spark, root), root))


@query("file_manifest_footers", sql(_BY_TYPE))
def file_manifest_footers(spark, sf_dir):
    return _by_type(footers.footer_manifest(spark, release_root(spark, sf_dir)))


@query("download_catalog", sql(
    """SELECT view_id AS request_id, type, file_no, rel_path FROM views JOIN manifest
      ON xmin < e AND xmax > w AND ymin < n AND ymax > s""", VIEW_SQL, _MANIFEST_SQL))
def download_catalog(spark, sf_dir):
    types = F.array(*(F.lit(type_) for types in THEME_TYPES.values() for type_ in types))
    requests = views(spark, sf_dir).select(
        F.col("view_id").alias("request_id"), "box", F.explode(types).alias("type"))
    return op.download_catalog(manifest(spark, sf_dir), requests)


# Releases are months of orders; a theme has tiles in the months its orders fall in.
_THEMES = [*THEME_TYPES, "weather"]
_RELEASE_SQL = f"""tiles AS (
  SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS release,
    CASE o_custkey % 7 {' '.join(f"WHEN {n} THEN '{theme}'" for n, theme in enumerate(_THEMES))} END AS theme
  FROM orders),
catalog AS (
  SELECT release, theme, release = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders) AS latest,
    release || '/' || theme AS path FROM tiles WHERE theme <> 'weather')"""


def release_tables(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("release"), "o_custkey")
    themes = F.array(*map(F.lit, _THEMES))
    tiles = orders.select("release", F.get(themes, (F.col("o_custkey") % 7).cast("int")).alias("theme"))
    return tiles, orders


@query("release_catalog", f"WITH {_RELEASE_SQL} SELECT * FROM catalog")
def release_catalog(spark, sf_dir):
    return op.release_catalog(*release_tables(spark, sf_dir))


@query("latest_release", f"""WITH {_RELEASE_SQL}
  SELECT release, theme, latest, path FROM catalog WHERE latest AND release NOT IN (
    SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < '2001-08-01')""")
def latest_release(spark, sf_dir):
    catalog = op.release_catalog(*release_tables(spark, sf_dir))
    seen = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_orderdate < '2001-08-01'").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("release"))
    return op.latest_release(catalog, seen)


@query("release_stream", f"""WITH {_RELEASE_SQL}
  SELECT release, theme, latest, orders, total, segments FROM catalog JOIN (
    SELECT strftime(o_orderdate, '%Y-%m') AS release, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS total,
      count(DISTINCT o_orderpriority) AS segments,
      CASE o_custkey % 7 {' '.join(f"WHEN {n} THEN '{theme}'" for n, theme in enumerate(_THEMES))} END AS theme
    FROM orders GROUP BY ALL) USING (release, theme)""")
def release_stream(spark, sf_dir):
    # Months of orders as releases; those before 1996 are announced first, the rest later, some twice.
    root, out = new_dir(spark, "releases"), new_dir(spark, "built")
    months = F.date_format("o_orderdate", "yyyy-MM")
    themes = F.array(*map(F.lit, _THEMES))
    rows = table(spark, sf_dir, "orders").select(
        months.alias("release"), F.get(themes, (F.col("o_custkey") % 7).cast("int")).alias("theme"),
        "o_orderkey", "o_orderpriority")
    rows.repartition("release").write.partitionBy("release", "theme").parquet(f"{root}/data")
    catalog = op.release_catalog(*release_tables(spark, sf_dir)).select(
        "release", "theme", F.concat(F.lit("release="), "release", F.lit("/theme="), "theme").alias("path"))

    def build(found):
        return found.groupBy("release", "theme").agg(
            F.count("*").alias("orders"), F.sum("o_orderkey").alias("total"),
            F.count_distinct("o_orderpriority").alias("segments"))

    for part in (catalog.where("release < '1996'"), catalog.where("release >= '1995-07'")):
        part.coalesce(1).write.mode("append").json(f"{root}/announced")
        stream.build_releases(spark, f"{root}/announced", f"{root}/data", f"{out}/built", f"{out}/checkpoint", build)
    built = stream.built_tables(spark, f"{out}/built")
    return built.join(stream.built(spark, f"{out}/built").drop("batch"), ["release", "theme"]).select(
        "release", "theme", "latest", "orders", "total", "segments")


_PLAIN = "regexp_replace(CAST({} AS VARCHAR), '\\.0$', '')".format


def _at(x: str, y: str) -> str:
    return f"'[' || {_PLAIN(x)} || ',' || {_PLAIN(y)} || ']'"


_RING = " || ',' || ".join(
    _at(x, y) for x, y in (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")))


# Well-known binary of the shapes, every fifth area as one of several parts.
@F.pandas_udf(T.BinaryType())
def _wkb(kind: pd.Series, multi: pd.Series, w: pd.Series, s: pd.Series, e: pd.Series, n: pd.Series) -> pd.Series:
    def one(kind, multi, w, s, e, n):
        if kind == "Point":
            return struct.pack("<BI2d", 1, 1, w, s)
        if kind == "LineString":
            return struct.pack("<BII4d", 1, 2, 2, w, s, e, n)
        area = struct.pack("<BIII10d", 1, 3, 1, 5, w, s, e, s, e, n, w, n, w, s)
        return struct.pack("<BII", 1, 6, 1) + area if multi else area

    return pd.Series([one(*row) for row in zip(kind, multi, w, s, e, n, strict=True)], dtype=object)


@query("export_geojson", sql(
    f"""SELECT type, '{{"type":"Feature","geometry":' || CASE
      WHEN geom_type = 'Point' THEN '{{"type":"Point","coordinates":' || {_at("xmin", "ymin")} || '}}'
      WHEN geom_type = 'LineString' THEN '{{"type":"LineString","coordinates":[' || {_at("xmin", "ymin")} || ',' || {_at("xmax", "ymax")} || ']}}'
      WHEN key % 5 = 0 THEN '{{"type":"MultiPolygon","coordinates":[[[' || {_RING} || ']]]}}'
      ELSE '{{"type":"Polygon","coordinates":[[' || {_RING} || ']]}}' END
      || ',"properties":{{"id":"' || id || '","bbox":{{"xmin":' || xmin || ',"xmax":' || xmax || ',"ymin":' || ymin || ',"ymax":' || ymax || '}}'
      || coalesce(',"subtype":"' || subtype || '"', '') || coalesce(',"names":' || names_json, '') || '}}}}' AS value
    FROM features WHERE {_CLIP}"""))
def export_geojson(spark, sf_dir):
    out = new_dir(spark, "geojson")
    sides = [F.col(f"bbox.{side}") for side in ("xmin", "ymin", "xmax", "ymax")]
    rows = features(spark, sf_dir).select(
        "theme", "type", "id", "bbox", "subtype", "names",
        _wkb("geom_type", F.col("key") % 5 == 0, *sides).alias("geometry"))
    export.export_geojson(rows, REGION, [t for types in THEME_TYPES.values() for t in types], out)
    return spark.read.text(out).select("type", "value")


@query("export_collections", sql(
    f"""SELECT type, id, CASE WHEN geom_type = 'Polygon' AND key % 5 = 0 THEN 'MultiPolygon' ELSE geom_type END AS kind,
      subtype, 'FeatureCollection' AS document FROM features WHERE {_CLIP}"""))
def export_collections(spark, sf_dir):
    # Whole documents, parsed as such.
    out = new_dir(spark, "collections")
    sides = [F.col(f"bbox.{side}") for side in ("xmin", "ymin", "xmax", "ymax")]
    rows = features(spark, sf_dir).select(
        "theme", "type", "id", "subtype", "bbox", _wkb("geom_type", F.col("key") % 5 == 0, *sides).alias("geometry"))
    geojson.export_collections(rows, REGION, [t for types in THEME_TYPES.values() for t in types], out, features_per_file=10_000)
    shape = "type string, features array<struct<geometry: struct<type: string>, properties: struct<id: string, subtype: string>>>"
    parsed = spark.read.text(out, wholetext=True).select("type", F.from_json("value", shape).alias("d"))
    return parsed.select("type", F.col("d.type").alias("document"), F.explode("d.features").alias("f")).select(
        "type", F.col("f.properties.id").alias("id"), F.col("f.geometry.type").alias("kind"),
        F.col("f.properties.subtype").alias("subtype"), "document")


@query("export_summary", sql(
    f"""SELECT view_id, {" || ',' || ".join(_PLAIN(side) for side in "wsen")} AS bbox_text, '2024-09-18' AS release,
      string_agg(DISTINCT type, ',' ORDER BY type) AS layers, count(DISTINCT type) AS layer_count, count(*) AS features
    FROM views JOIN features ON xmin <= e AND xmax >= w AND ymin <= n AND ymax >= s
    GROUP BY view_id, w, s, e, n""", VIEW_SQL))
def export_summary(spark, sf_dir):
    pairs = view_op.view_extract(features(spark, sf_dir).select("id", "type", "bbox"), views(spark, sf_dir))
    made = datetime(2026, 1, 15, 12, 34, 56)
    return export.export_summaries(pairs, "2024-09-18", made).select(
        "view_id", "bbox_text", "release", "layers", "layer_count", "features")


def _download(spark, sf_dir):
    root = release_root(spark, sf_dir)
    files = op.file_manifest(release.scan_release(spark, root), root)
    return op.download_extract(spark, files, root, REGION, [t for types in THEME_TYPES.values() for t in types])


@query("download_extract", sql(f"SELECT id, theme, type, subtype, number FROM features WHERE {_CLIP}"))
def download_extract(spark, sf_dir):
    return _download(spark, sf_dir).select("id", "theme", "type", "subtype", "number")


_VIEW_URL = "https://example.org/?mode=explore#5/45/13"


@query("download_summary", sql(
    f"""SELECT string_agg(DISTINCT type, ',' ORDER BY type) AS layers, count(DISTINCT type) AS layer_count,
      count(*) AS features, '2024-09-18' AS release, '{_VIEW_URL}' AS view_url FROM features WHERE {_CLIP}"""))
def download_summary(spark, sf_dir):
    made = datetime(2026, 1, 15, 12, 34, 56)
    return export.export_summary(_download(spark, sf_dir), REGION, "2024-09-18", made, _VIEW_URL).select(
        "layers", "layer_count", "features", "release", "view_url")


_FIXED = "printf('%.3f', {})".format


@query("bbox_label", sql(
    f"""SELECT id, label, 'features-2024-09-18-' || type || '-' || label || '.geojson' AS file_name,
      'features-2024-09-18-' || label || '.zip' AS archive_name
    FROM (SELECT id, type, {" || ',' || ".join(_FIXED(side) for side in ("xmin", "ymin", "xmax", "ymax"))} AS label
      FROM (SELECT * EXCLUDE (label) FROM features))"""))
def bbox_label(spark, sf_dir):
    rows = features(spark, sf_dir).select("id", "type", F.col("bbox").alias("box"))
    return export.bbox_label(rows, "2024-09-18").select("id", "label", "file_name", "archive_name")
