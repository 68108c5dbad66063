"""Tile profiles, tags, tile assignment and tile statistics."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapsheaf.operators import cover as op_cover
from mapsheaf.operators import tags as tag
from mapsheaf.operators import tiling
from mapsheaf.plans import profiles
from mapsheaf.queries.fixture import features, sql
from mapsheaf.queries.registry import query
from mapsheaf.session import new_dir
from mapsheaf.sources import versions
from mapsheaf.sources.release import union_types
from mapsheaf.sources.tiles import tile_table as write_tile_table

ZOOMS = ["min_zoom", "max_zoom", "tags_zoom", "min_pixel"]

BASE_ZOOM = """CASE type
      WHEN 'infrastructure' THEN 13
      WHEN 'land' THEN CASE WHEN geom_type = 'Point' THEN 13 WHEN subtype IN ('land', 'glacier') THEN 0 ELSE 7 END
      WHEN 'bathymetry' THEN 0
      WHEN 'land_use' THEN CASE WHEN geom_type = 'Point' THEN 13 WHEN subtype = 'residential' THEN 6 ELSE 9 END
      WHEN 'land_cover' THEN draw_from
      WHEN 'water' THEN CASE WHEN subtype = 'ocean' THEN 0 WHEN geom_type = 'Point' THEN 8
                             WHEN geom_type = 'Polygon' THEN 4 WHEN subtype = 'river' THEN 9 ELSE 13 END
    END"""

DIVISION_ZOOM = "CASE subtype WHEN 'country' THEN 0 WHEN 'dependency' THEN 0 WHEN 'region' THEN 4 WHEN 'county' THEN 8 ELSE 10 END"

SEGMENT_ZOOM = """CASE WHEN type = 'connector' THEN 13
      WHEN subtype = 'road' THEN CASE class WHEN 'motorway' THEN 4 WHEN 'trunk' THEN 5 WHEN 'primary' THEN 7
        WHEN 'secondary' THEN 9 WHEN 'tertiary' THEN 11 WHEN 'residential' THEN 12 WHEN 'living_street' THEN 13 ELSE 14 END
      WHEN subtype = 'rail' THEN 8 ELSE 10 END"""

# Zoom columns of all features, theme by theme.
ZOOMED = f"""zoomed AS (
  SELECT *,
    CASE theme WHEN 'addresses' THEN 14 WHEN 'places' THEN 14 WHEN 'base' THEN {BASE_ZOOM}
      WHEN 'divisions' THEN {DIVISION_ZOOM} WHEN 'transportation' THEN {SEGMENT_ZOOM} END AS min_zoom,
    CASE theme WHEN 'divisions' THEN 12
      WHEN 'base' THEN CASE WHEN type = 'land_cover' THEN least(draw_from + 5, 13) ELSE 13 END
      ELSE 14 END AS max_zoom,
    CASE theme WHEN 'divisions' THEN {DIVISION_ZOOM}
      WHEN 'base' THEN CASE WHEN type IN ('land_cover', 'water') THEN {BASE_ZOOM} ELSE 13 END
      ELSE 14 END AS tags_zoom,
    CASE WHEN type IN ('segment', 'bathymetry', 'division_area', 'division_boundary') THEN 0
      WHEN type = 'land' AND geom_type <> 'Point' AND subtype IN ('land', 'glacier') THEN 0
      WHEN type = 'water' AND geom_type = 'Polygon' THEN 0
      WHEN type = 'water' AND geom_type = 'LineString' AND subtype = 'ocean' THEN 0 END AS min_pixel
  FROM features)"""


def _zoomed_sql(theme: str) -> str:
    return sql(f"SELECT id, type, {', '.join(ZOOMS)} FROM zoomed WHERE theme = '{theme}'", ZOOMED)


def zoomed(spark, sf_dir):
    """All features with the zooms of their theme's profile."""
    return union_types([
        profiles.theme_profile(features(spark, sf_dir, theme), theme).drop("@height_source", "@geometry_source")
        for theme in profiles.PROFILES
    ])


def _register_zoom(theme, run):
    @query(f"zoom_{theme}", _zoomed_sql(theme))
    def zoom(spark, sf_dir):
        return run(features(spark, sf_dir, theme)).select("id", "type", *ZOOMS)


_register_zoom("addresses", profiles.zoom_addresses)
_register_zoom("places", profiles.zoom_places)
_register_zoom("base", profiles.zoom_base)
_register_zoom("buildings", profiles.zoom_buildings)
_register_zoom("divisions", profiles.zoom_divisions)
_register_zoom("transportation", profiles.zoom_transportation)


@query("theme_profile", sql(f"SELECT id, theme, type, {', '.join(ZOOMS)} FROM zoomed", ZOOMED))
def theme_profile(spark, sf_dir):
    return zoomed(spark, sf_dir).select("id", "theme", "type", *ZOOMS)


@query("geometry_layer_kind", sql(
    """SELECT id, type AS layer,
      CASE geom_type WHEN 'Point' THEN 'point' WHEN 'Polygon' THEN 'polygon' ELSE 'line' END AS layer_kind
    FROM features"""))
def geometry_layer_kind(spark, sf_dir):
    return tag.geometry_layer_kind(features(spark, sf_dir)).select("id", "layer", "layer_kind")


@query("flatten_tags", sql(
    """SELECT id, type, subtype, class, height, names_json AS names, label AS "@name",
      CASE WHEN draw_from IS NOT NULL THEN
        '{"min_zoom":' || draw_from || ',"max_zoom":' || (draw_from + 5) || '}' END AS cartography,
      CASE WHEN category IS NOT NULL THEN
        '{"primary":"' || category || '","alternate":["other"]}' END AS categories
    FROM features"""))
def flatten_tags(spark, sf_dir):
    return tag.flatten_tags(features(spark, sf_dir)).select(
        "id", "type", "subtype", "class", "height", "names", "@name", "cartography", "categories")


@query("primary_label", sql('SELECT id, label AS "@name" FROM features'))
def primary_label(spark, sf_dir):
    return tag.primary_label(features(spark, sf_dir)).select("id", "@name")


# The fixture's sources follow from the key, so SQL needs no join for them.
_ROOT_SQL = "CASE WHEN key % 10 <> 3 THEN 'OpenStreetMap' END"


@query("height_source", sql(
    f"""SELECT id, height, CASE WHEN key % 4 = 0 THEN 'meta' WHEN height IS NOT NULL THEN {_ROOT_SQL} END
      AS "@height_source" FROM features WHERE theme = 'buildings'"""))
def height_source(spark, sf_dir):
    return tag.height_source(features(spark, sf_dir, "buildings")).select("id", "height", "@height_source")


@query("geometry_source", sql(
    f"""SELECT id, height, CASE WHEN key % 9 = 0 THEN 'Esri' ELSE {_ROOT_SQL} END AS "@geometry_source"
    FROM features WHERE theme = 'buildings'"""))
def geometry_source(spark, sf_dir):
    return tag.geometry_source(features(spark, sf_dir, "buildings")).select("id", "height", "@geometry_source")


@query("stable_feature_id", sql(
    """SELECT type, count(*) AS features, count(DISTINCT id) AS ids, count(DISTINCT id) AS feature_ids
    FROM features GROUP BY type"""))
def stable_feature_id(spark, sf_dir):
    # The numbers differ by hash function; there must be exactly one for each text id.
    rows = tag.stable_feature_id(features(spark, sf_dir))
    ids = rows.groupBy("type", "id").agg(
        F.count("*").alias("n"), F.min("feature_id").alias("low"), F.max("feature_id").alias("high"))
    return ids.groupBy("type").agg(
        F.sum("n").alias("features"), F.count("*").alias("ids"),
        F.count_distinct(F.when(F.col("low") == F.col("high"), F.col("low"))).alias("feature_ids"))


def _y(latitude: str) -> str:
    angle = f"(greatest(-85.0511287, least(85.0511287, {latitude})) * pi() / 180)"
    return f"((1 - ln(tan({angle}) + 1 / cos({angle})) / pi()) / 2)"


def _tile(world: str, zoom: str) -> str:
    return (f"CAST(greatest(0, least(pow(2.0, {zoom}) - 1, floor({world} * pow(2.0, {zoom})))) AS INTEGER)")


def _pixels(zoom: str) -> str:
    return (f"(greatest((xmax + 180) / 360 - (xmin + 180) / 360, {_y('ymin')} - {_y('ymax')}) "
            f"* 256 * pow(2.0, {zoom}))")


# Every 97th feature that has a width lies across 180 degrees here.
CROSSING = "key % 97 = 0 AND xmax > xmin"
ACROSS = f"""across AS (SELECT * REPLACE (CASE WHEN {CROSSING} THEN 180 - (xmax - xmin) / 2 ELSE xmin END AS xmin,
    CASE WHEN {CROSSING} THEN (xmax - xmin) / 2 - 180 ELSE xmax END AS xmax) FROM zoomed)"""


def across(df):
    """The same features in Spark."""
    wide = F.col("bbox.xmax") - F.col("bbox.xmin")
    moved = F.struct((180 - wide / 2).alias("xmin"), (wide / 2 - 180).alias("xmax"), F.col("bbox.ymin"), F.col("bbox.ymax"))
    return df.withColumn("bbox", F.when((F.col("key") % 97 == 0) & (wide > 0), moved).otherwise(F.col("bbox")))


# Tiles of a feature at a zoom are one rectangle or two, so SQL adds them up without listing them.
TILED = f"""runs AS (
  SELECT theme, type, key, z, xmin > xmax AS crosses, CAST(pow(2, z) - 1 AS INTEGER) AS edge,
    {_tile('((xmin + 180) / 360)', 'z')} AS west, {_tile('((xmax + 180) / 360)', 'z')} AS east,
    {_tile(_y('ymax'), 'z')} AS y0, {_tile(_y('ymin'), 'z')} AS y1
  FROM across, generate_series(0, 14) AS steps(z)
  WHERE z >= coalesce(min_zoom, 0) AND z <= max_zoom),
ranged AS (
  SELECT theme, type, key, z, west AS x0, east AS x1, y0, y1 FROM runs WHERE NOT crosses
  UNION ALL SELECT theme, type, key, z, west, edge, y0, y1 FROM runs WHERE crosses AND west > east + 1
  UNION ALL SELECT theme, type, key, z, 0, east, y0, y1 FROM runs WHERE crosses AND west > east + 1
  UNION ALL SELECT theme, type, key, z, 0, edge, y0, y1 FROM runs WHERE crosses AND west <= east + 1),
sized AS (SELECT *, CAST(x1 - x0 + 1 AS BIGINT) AS nx, CAST(y1 - y0 + 1 AS BIGINT) AS ny FROM ranged),
tiled AS (
  SELECT theme, type, z, CAST(sum(nx * ny) AS BIGINT) AS tiles,
    CAST(sum((x0 + x1) * nx * ny) AS BIGINT) // 2 AS x_sum, CAST(sum((y0 + y1) * nx * ny) AS BIGINT) // 2 AS y_sum,
    CAST(sum(key * nx * ny) AS BIGINT) AS key_sum
  FROM sized GROUP BY ALL)"""


def tile_sums(tiles):
    """Tiles of each theme, type and zoom, counted and added up."""
    return tiles.groupBy("theme", "type", "z").agg(
        F.count("*").alias("tiles"), F.sum("x").alias("x_sum"), F.sum("y").alias("y_sum"), F.sum("key").alias("key_sum"))


@query("tile_assign", sql("SELECT * FROM tiled", ZOOMED, ACROSS, TILED))
def tile_assign(spark, sf_dir):
    rows = zoomed(spark, sf_dir).select("id", "theme", "type", "key", "bbox", "min_zoom", "max_zoom")
    return tile_sums(tiling.tile_assign(across(rows), 0, 14))


# Shapes that are not their boxes: lines and the long sides of triangles run from corner to corner.
@F.pandas_udf(T.BinaryType())
def _slanted(kind: pd.Series, w: pd.Series, s: pd.Series, e: pd.Series, n: pd.Series) -> pd.Series:
    def one(kind, w, s, e, n):
        if kind == "Point":
            return struct.pack("<BI2d", 1, 1, w, s)
        if kind == "LineString":
            return struct.pack("<BII4d", 1, 2, 2, w, s, e, n)
        return struct.pack("<BIII8d", 1, 3, 1, 4, w, s, e, s, e, n, w, s)

    return pd.Series([one(*row) for row in zip(kind, w, s, e, n, strict=True)], dtype=object)


def slanted(df):
    sides = [F.col(f"bbox.{side}") for side in ("xmin", "ymin", "xmax", "ymax")]
    return df.withColumn("geometry", _slanted("geom_type", *sides))


# In each row of tiles, from where the slanted side passes to its other end or to the eastern side.
_PASS = "x_from + ({} - y_from) / CASE WHEN y_to = y_from THEN 1 ELSE y_to - y_from END * (x_to - x_from)"
COVERED = f"""world AS (
  SELECT theme, type, key, z, geom_type = 'Polygon' AS area, pow(2.0, z) AS n,
    (xmin + 180) / 360 * pow(2.0, z) AS w, (xmax + 180) / 360 * pow(2.0, z) AS e,
    {_y('ymin')} * pow(2.0, z) AS s, {_y('ymax')} * pow(2.0, z) AS t, geom_type = 'Point' AS point
  FROM zoomed, generate_series(0, 14) AS steps(z)
  WHERE z >= coalesce(min_zoom, 0) AND z <= max_zoom),
sides AS (
  SELECT *, CASE WHEN area THEN e ELSE w END AS x_from, CASE WHEN area THEN t ELSE s END AS y_from,
    CASE WHEN area THEN w WHEN point THEN w ELSE e END AS x_to, CASE WHEN area THEN s WHEN point THEN s ELSE t END AS y_to,
    unnest(range(CAST(floor(CASE WHEN point THEN s ELSE t END) AS BIGINT), CAST(floor(s) AS BIGINT) + 1)) AS r FROM world),
passed AS (
  SELECT *, CASE WHEN y_from = y_to THEN x_from ELSE {_PASS.format('greatest(least(y_from, y_to), r)')} END AS a,
    CASE WHEN y_from = y_to THEN x_to ELSE {_PASS.format('least(greatest(y_from, y_to), r + 1)')} END AS b FROM sides),
spans AS (
  SELECT theme, type, key, z, CAST(greatest(0, least(n - 1, r)) AS BIGINT) AS y,
    CAST(greatest(0, least(n - 1, floor(CASE WHEN area AND r = floor(s) THEN least(a, b, w) ELSE least(a, b) END))) AS BIGINT) AS lo,
    CAST(greatest(0, least(n - 1, floor(CASE WHEN area THEN greatest(a, b, e) ELSE greatest(a, b) END))) AS BIGINT) AS hi
  FROM passed)"""


@query("tile_cover", sql(
    """SELECT theme, type, z, CAST(sum(hi - lo + 1) AS BIGINT) AS tiles, CAST(sum((lo + hi) * (hi - lo + 1)) AS BIGINT) // 2 AS x_sum,
      CAST(sum(y * (hi - lo + 1)) AS BIGINT) AS y_sum, CAST(sum(key * (hi - lo + 1)) AS BIGINT) AS key_sum
    FROM spans GROUP BY ALL""", ZOOMED, COVERED))
def tile_cover(spark, sf_dir):
    rows = zoomed(spark, sf_dir).select("id", "theme", "type", "key", "geom_type", "bbox", "min_zoom", "max_zoom")
    return tile_sums(op_cover.tile_cover(slanted(rows), 0, 14))


# Length of a line, root of half the box for a triangle.
_EXTENT = (f"CASE geom_type WHEN 'LineString' THEN sqrt(pow((xmax + 180) / 360 - (xmin + 180) / 360, 2) + pow({_y('ymin')} - {_y('ymax')}, 2))"
           f" WHEN 'Polygon' THEN sqrt(((xmax + 180) / 360 - (xmin + 180) / 360) * ({_y('ymin')} - {_y('ymax')}) / 2) ELSE 0 END")


@query("min_pixel_by_shape", sql("\nUNION ALL\n".join(
    f"""SELECT id, {z} AS zoom FROM zoomed
    WHERE geom_type = 'Point' OR {_EXTENT} * 256 * pow(2.0, {z}) >= coalesce(min_pixel, 1)""" for z in (3, 8, 13)), ZOOMED))
def min_pixel_by_shape(spark, sf_dir):
    rows = op_cover.with_extent(slanted(zoomed(spark, sf_dir).select("id", "bbox", "geom_type", "min_pixel")))
    zooms = F.explode(F.array(*map(F.lit, (3, 8, 13)))).alias("zoom")
    return tag.min_pixel_filter(rows.select("id", "bbox", "geom_type", "min_pixel", "extent", zooms), F.col("zoom")).select("id", "zoom")


@query("attribute_visibility_by_shape", sql("\nUNION ALL\n".join(
    f"""SELECT id, {z} AS zoom, CASE WHEN {_EXTENT} * 256 * pow(2.0, {z}) >= 16 OR {z} >= tags_zoom THEN
      CASE WHEN subtype IS NULL THEN 0 ELSE 1 END + CASE WHEN class IS NULL THEN 0 ELSE 1 END
      ELSE 0 END AS tag_count FROM zoomed""" for z in (5, 9, 13)), ZOOMED))
def attribute_visibility_by_shape(spark, sf_dir):
    rows = op_cover.with_extent(slanted(zoomed(spark, sf_dir).select(
        "id", "geom_type", "bbox", "tags_zoom", "subtype", "class"))).drop("geometry", "geom_type")
    tagged = tag.tag_map(rows, skip=("id",)).withColumn("zoom", F.explode(F.array(*map(F.lit, (5, 9, 13)))))
    return tag.attribute_visibility(tagged, F.col("zoom")).select("id", "zoom", F.size("tags").alias("tag_count"))


@query("attribute_visibility", sql("\nUNION ALL\n".join(
    f"""SELECT id, {z} AS zoom, CASE WHEN {_pixels(str(z))} >= 16 OR {z} >= tags_zoom THEN
      2 + CASE WHEN subtype IS NULL THEN 0 ELSE 1 END + CASE WHEN class IS NULL THEN 0 ELSE 1 END
      ELSE 0 END + CASE WHEN theme = 'buildings' THEN
        CASE WHEN key % 4 = 0 OR (height IS NOT NULL AND key % 10 <> 3) THEN 1 ELSE 0 END
        + CASE WHEN key % 9 = 0 OR key % 10 <> 3 THEN 1 ELSE 0 END ELSE 0 END AS tag_count FROM zoomed""" for z in (5, 9, 13)), ZOOMED))
def attribute_visibility(spark, sf_dir):
    # The sources of buildings are shown at every zoom.
    rows = union_types([
        profiles.theme_profile(features(spark, sf_dir, theme), theme) for theme in profiles.PROFILES
    ]).select("id", "type", "bbox", "min_zoom", "tags_zoom", "subtype", "class", "@height_source", "@geometry_source")
    tagged = tag.tag_map(rows).withColumn("zoom", F.explode(F.array(*map(F.lit, (5, 9, 13)))))
    return tag.attribute_visibility(tagged, F.col("zoom")).select("id", "zoom", F.size("tags").alias("tag_count"))


@query("min_pixel_filter", sql("\nUNION ALL\n".join(
    f"""SELECT id, {z} AS zoom FROM zoomed
    WHERE geom_type = 'Point' OR {_pixels(str(z))} >= coalesce(min_pixel, 1)""" for z in (3, 8, 13)), ZOOMED))
def min_pixel_filter(spark, sf_dir):
    zooms = F.array(*map(F.lit, (3, 8, 13)))
    rows = zoomed(spark, sf_dir).select("id", "bbox", "geom_type", "min_pixel", F.explode(zooms).alias("zoom"))
    return tag.min_pixel_filter(rows, F.col("zoom")).select("id", "zoom")


# Every 97th place has a box across 180 degrees.
_MIDDLE = "CASE WHEN key % 97 = 0 THEN (179.75 + -179.25) / 2 - 180 ELSE (xmin + xmax) / 2 END"


@query("place_density", sql("\nUNION ALL\n".join(
    f"""SELECT {z} AS z, {_tile(f'(({_MIDDLE} + 180) / 360)', str(z))} AS x,
      {_tile(_y('(ymin + ymax) / 2'), str(z))} AS y, count(*) AS places,
      1 + 2 * (CAST({z} AS DOUBLE) / 9) AS intensity, 2 + 4 * (CAST({z} AS DOUBLE) / 9) AS radius
    FROM features WHERE theme = 'places' GROUP BY ALL""" for z in range(9))))
def place_density(spark, sf_dir):
    places = features(spark, sf_dir, "places")
    wide = F.struct(F.lit(179.75).alias("xmin"), F.lit(-179.25).alias("xmax"), F.col("bbox.ymin"), F.col("bbox.ymax"))
    places = places.withColumn("bbox", F.when(F.col("key") % 97 == 0, wide).otherwise(F.col("bbox")))
    columns = ["z", "x", "y", "places", "intensity", "radius"]
    return tiling.place_density(places, *range(9)).select(*columns)


STATS_FIELDS = ["id", "subtype", "class", "height", "population", "has_parts"]


@query("tile_layer_stats", sql(
    """SELECT layers.*, theme_minzoom, theme_maxzoom, west, south, east, north FROM (
      SELECT theme, layer, field,
        CASE field WHEN 'height' THEN 'Number' WHEN 'population' THEN 'Number' WHEN 'has_parts' THEN 'Boolean'
          ELSE 'String' END AS field_type,
        min(z) AS layer_minzoom, max(z) AS layer_maxzoom
      FROM (SELECT theme, type AS layer, z,
          unnest(['id', 'subtype', 'class', 'height', 'population', 'has_parts']) AS field,
          unnest([1, n_subtype, n_class, n_height, n_population, n_has_parts]) AS carried
        FROM (SELECT theme, type, z,
            count(subtype) OVER w AS n_subtype, count(class) OVER w AS n_class, count(height) OVER w AS n_height,
            count(population) OVER w AS n_population, count(has_parts) OVER w AS n_has_parts
          FROM stepped WINDOW w AS (PARTITION BY theme, type)))
      WHERE carried > 0 GROUP BY theme, layer, field) layers
    JOIN (SELECT theme, min(z) AS theme_minzoom, max(z) AS theme_maxzoom, min(xmin) AS west, min(ymin) AS south,
        max(xmax) AS east, max(ymax) AS north FROM stepped GROUP BY theme) themes USING (theme)""",
    ZOOMED,
    """stepped AS (SELECT zoomed.*, z FROM zoomed, generate_series(0, 14) AS steps(z)
      WHERE z >= coalesce(min_zoom, 0) AND z <= max_zoom)"""))
def tile_layer_stats(spark, sf_dir):
    rows = zoomed(spark, sf_dir).select("theme", "type", "bbox", "min_zoom", "max_zoom", *STATS_FIELDS)
    return tiling.tile_layer_stats(rows, 0, 14)


@query("tile_table", sql("SELECT * FROM tiled", ZOOMED, ACROSS, TILED))
def tile_table(spark, sf_dir):
    # The stored tables of all themes, read back and added up.
    out = new_dir(spark, "tiles")
    for theme in profiles.PROFILES:
        rows = profiles.theme_profile(features(spark, sf_dir, theme), theme).select(
            "id", "theme", "type", "key", "bbox", "min_zoom", "max_zoom")
        tiles = tiling.tile_assign(across(rows), 0, 14, by_place=0).drop("bbox", "min_zoom", "max_zoom")
        write_tile_table(tiles, out, theme, arranged=True)
    return tile_sums(spark.read.option("basePath", out).parquet(*(f"{out}/theme={t}" for t in profiles.PROFILES)))


@query("tile_update", sql("SELECT * FROM tiled", ZOOMED, ACROSS, TILED))
def tile_update(spark, sf_dir):
    # The release before: some features lay elsewhere, some are gone since, some are new now.
    # Its tiles are brought to the present ones by the blocks that changed.
    out, key, depth = new_dir(spark, "tile-versions"), F.col("key"), 2

    def assign(rows):
        return tiling.tile_assign(rows, 0, 14, by_place=depth).select("theme", "type", "id", "key", "z", "x", "y")

    now = across(zoomed(spark, sf_dir).select("id", "theme", "type", "key", "bbox", "min_zoom", "max_zoom"))
    moved = F.struct((F.col("bbox.xmin") / 2).alias("xmin"), (F.col("bbox.xmin") / 2).alias("xmax"),
                     F.col("bbox.ymin"), F.col("bbox.ymax"))
    then = now.where(key % 211 != 0).withColumn("bbox", F.when(key % 199 == 0, moved).otherwise(F.col("bbox")))
    then = then.union(now.where(key % 223 == 0).withColumn("id", F.concat("id", F.lit(".gone"))))
    versions.build_tiles(spark, out, "all", then, assign, depth, arranged=True)
    versions.update_tiles(spark, out, "all", then, now, assign, arranged=True)
    return tile_sums(versions.read_tiles(spark, out, "all"))
