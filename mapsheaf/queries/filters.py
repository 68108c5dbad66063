"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapsheaf.operators import filters as op
from mapsheaf.operators.inspector import properties_of
from mapsheaf.operators.tags import feature_label
from mapsheaf.plans.rules import NAMED_ROAD_CLASSES, PLACE_CATEGORIES, rule_table
from mapsheaf.queries.fixture import features, rules_sql, sql
from mapsheaf.queries.registry import query
from mapsheaf.sources.release import union_types

# A box whose western and southern sides are also sides of features.
REGION = (-10.0, 29.45, 35.91, 60.0)


def listed(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


@query("bbox_clip", sql(
    "SELECT id, type FROM features WHERE xmin <= 35.91 AND xmax >= -10 AND ymin <= 60 AND ymax >= 29.45"))
def bbox_clip(spark, sf_dir):
    return op.bbox_clip(features(spark, sf_dir), REGION).select("id", "type")


@query("bbox_overlap", sql(
    "SELECT id, type FROM features WHERE xmin < 35.91 AND xmax > -10 AND ymin < 60 AND ymax > 29.45"))
def bbox_overlap(spark, sf_dir):
    return op.bbox_overlap(features(spark, sf_dir), REGION).select("id", "type")


@query("geometry_kind_filter", sql("SELECT id, type, geom_type FROM features WHERE geom_type = 'LineString'"))
def geometry_kind_filter(spark, sf_dir):
    return op.geometry_kind_filter(features(spark, sf_dir), "LineString").select("id", "type", "geom_type")


@query("class_match_filter", sql(
    "SELECT id, class FROM features WHERE class IN ('park', 'golf_course', 'footway', 'steps', 'maritime')"))
def class_match_filter(spark, sf_dir):
    kept = op.class_match_filter(
        features(spark, sf_dir), "class", ("park", "golf_course", "footway", "steps", "maritime"))
    return kept.select("id", "class")


@query("class_exclude_filter", sql(
    "SELECT id, subtype, class FROM features WHERE type = 'segment' AND "
    f"(class IS NULL OR class NOT IN ({listed(NAMED_ROAD_CLASSES)}))"))
def class_exclude_filter(spark, sf_dir):
    segments = features(spark, sf_dir, "transportation").where("type = 'segment'")
    return op.class_exclude_filter(segments, "class", NAMED_ROAD_CLASSES).select("id", "subtype", "class")


@query("has_field_filter", sql(
    "SELECT id, type, subtype FROM features WHERE theme = 'base' AND subtype IS NOT NULL AND is_intermittent IS NULL"))
def has_field_filter(spark, sf_dir):
    kept = op.has_field_filter(features(spark, sf_dir, "base"), ["subtype"], ["is_intermittent"])
    return kept.select("id", "type", "subtype")


_CONFIDENT = """SELECT id, confidence, {zoom} AS zoom FROM features WHERE theme = 'places' AND confidence >=
  CASE WHEN {zoom} >= 17 THEN 0.9 WHEN {zoom} >= 16 THEN 0.95 WHEN {zoom} >= 15 THEN 0.97 ELSE 0.99 END"""


@query("confidence_filter", sql("\nUNION ALL\n".join(_CONFIDENT.format(zoom=z) for z in (14, 15, 16, 17))))
def confidence_filter(spark, sf_dir):
    places = features(spark, sf_dir, "places").select("id", "confidence")
    return places.withColumn("zoom", F.explode(F.array(*map(F.lit, (14, 15, 16, 17))))).transform(
        op.confidence_filter, F.col("zoom"))


@query("population_filter", sql("\nUNION ALL\n".join(
    f"""SELECT id, population, {z} AS zoom FROM features WHERE subtype = 'locality' AND
    CASE WHEN {z} >= 13 THEN TRUE WHEN {z} >= 12 THEN population >= 10000
         WHEN {z} >= 11 THEN population >= 50000 ELSE population >= 1000000 END"""
    for z in (9, 11, 12, 13))))
def population_filter(spark, sf_dir):
    zooms = F.array(*map(F.lit, (9, 11, 12, 13)))
    divisions = features(spark, sf_dir, "divisions").select(
        "id", "subtype", "population", F.explode(zooms).alias("zoom"))
    return op.population_filter(divisions, F.col("zoom")).select("id", "population", "zoom")


_LABEL_SQL = """SELECT id, label, '{kind}' AS kind, {zoom} AS zoom FROM features
  WHERE theme = 'divisions' AND length(label) <= CASE {cases} END"""
_LABEL_CASES = {
    "country": "WHEN {zoom} >= 7 THEN 999 WHEN {zoom} >= 5 THEN 50 WHEN {zoom} >= 3 THEN 25 ELSE 15",
    "region": "WHEN {zoom} >= 8 THEN 999 WHEN {zoom} >= 6 THEN 30 ELSE 15",
}


@query("label_length_filter", sql("\nUNION ALL\n".join(
    _LABEL_SQL.format(kind=kind, zoom=zoom, cases=cases.format(zoom=zoom))
    for kind, cases in _LABEL_CASES.items() for zoom in (2, 4, 6, 8))))
def label_length_filter(spark, sf_dir):
    zooms = F.array(*map(F.lit, (2, 4, 6, 8)))
    divisions = features(spark, sf_dir, "divisions").select("id", "names", F.explode(zooms).alias("zoom"))
    return union_types([
        op.label_length_filter(divisions, kind, F.col("zoom")).select(
            "id", feature_label(divisions).alias("label"), F.lit(kind).alias("kind"), "zoom")
        for kind in ("country", "region")
    ])


_STEPPED = {
    "land": ("type = 'land'", "subtype IS NULL", (5, "class = 'land' OR subtype IS NULL")),
    "ocean": ("type = 'water'", "subtype IS NULL", (5, "subtype = 'ocean'")),
    "lake_or_river": ("type = 'water'", "subtype IS NOT NULL", (5, "subtype IS DISTINCT FROM 'ocean'")),
    "boundary": ("type = 'division_boundary'", "TRUE", (8, "class IS DISTINCT FROM 'maritime'")),
    "local_area": (
        "type = 'division'", "subtype = 'borough'",
        (10, "subtype IN ('borough', 'localadmin')"),
        (11, "subtype IN ('borough', 'localadmin', 'macrohood')"),
        (13, "subtype IN ('borough', 'localadmin', 'macrohood', 'neighborhood')"),
        (14, "subtype IN ('borough', 'localadmin', 'macrohood', 'neighborhood', 'microhood')")),
}


def _stepped_sql(name: str, zoom: int) -> str:
    type_, first, *later = _STEPPED[name]
    cases = " ".join(f"WHEN {zoom} >= {start} THEN {test}" for start, test in reversed(later))
    return (f"SELECT id, '{name}' AS name, {zoom} AS zoom FROM features "
            f"WHERE {type_} AND CASE {cases} ELSE {first} END")


_STEPPED_ZOOMS = (4, 7, 9, 10, 11, 13, 14)


@query("stepped_class_filter", sql("\nUNION ALL\n".join(
    _stepped_sql(name, zoom) for name in _STEPPED for zoom in _STEPPED_ZOOMS)))
def stepped_class_filter(spark, sf_dir):
    rows = features(spark, sf_dir, "base", "divisions").select("id", "type", "subtype", "class")
    zooms = F.array(*map(F.lit, _STEPPED_ZOOMS))
    types = {"land": "land", "ocean": "water", "lake_or_river": "water",
             "boundary": "division_boundary", "local_area": "division"}
    return union_types([
        op.stepped_class_filter(
            rows.where(F.col("type") == type_).withColumn("zoom", F.explode(zooms)), name, F.col("zoom"))
        .select("id", F.lit(name).alias("name"), "zoom")
        for name, type_ in types.items()
    ])


@query("zoom_window_filter", sql(
    """SELECT mode, zoom, id, type, rule_id
    FROM features JOIN rules ON type = rule_type, (VALUES (3), (8), (13)) AS zooms(zoom)
    WHERE zoom >= coalesce(minzoom, zoom) AND zoom < coalesce(maxzoom, zoom + 1)""", rules_sql("explore", "inspect")))
def zoom_window_filter(spark, sf_dir):
    zooms = F.array(*map(F.lit, (3, 8, 13)))
    rules = union_types([
        op.zoom_window_filter(
            rule_table(spark, mode).withColumn("zoom", F.explode(zooms)), F.col("zoom"))
        .select(F.lit(mode).alias("mode"), "zoom", F.col("rule_type").alias("type"), "rule_id")
        for mode in ("explore", "inspect")
    ])
    return features(spark, sf_dir).select("id", "type").join(F.broadcast(rules), "type").select(
        "mode", "zoom", "id", "type", "rule_id")


@query("category_match_filter", sql("\nUNION ALL\n".join(
    f"SELECT id, category, '{group}' AS place_group FROM features WHERE category IN ({listed(values)})"
    for group, values in PLACE_CATEGORIES.items())))
def category_match_filter(spark, sf_dir):
    groups = F.array(*map(F.lit, PLACE_CATEGORIES))
    places = features(spark, sf_dir, "places").select("id", "categories", F.explode(groups).alias("place_group"))
    return op.category_match_filter(places, F.col("place_group")).select(
        "id", F.col("categories.primary").alias("category"), "place_group")


@query("category_contains_filter", sql(
    """SELECT id, category FROM features WHERE contains(category, 'restaurant')
    UNION ALL SELECT id, category FROM features WHERE contains(category, 'shop')"""))
def category_contains_filter(spark, sf_dir):
    places = features(spark, sf_dir, "places").select("id", "categories")
    return union_types([
        op.category_contains_filter(places, word).select("id", F.col("categories.primary").alias("category"))
        for word in ("restaurant", "shop")
    ])


@query("whole_building_filter", sql(
    "SELECT id, has_parts FROM features WHERE type = 'building' AND has_parts IS DISTINCT FROM TRUE"))
def whole_building_filter(spark, sf_dir):
    rows = features(spark, sf_dir, "buildings").where("type = 'building'")
    return op.whole_building_filter(rows).select("id", "has_parts")


@query("low_zoom_base_filter", sql(
    """SELECT id, theme, CAST(key % 15 AS INT) AS zoom, key % 3 = 0 AS inspect FROM features
    WHERE NOT (key % 15 < 10 AND key % 3 <> 0 AND theme = 'base')"""))
def low_zoom_base_filter(spark, sf_dir):
    rows = features(spark, sf_dir).select(
        "id", "theme", (F.col("key") % 15).cast("int").alias("zoom"), (F.col("key") % 3 == 0).alias("inspect"))
    return op.low_zoom_base_filter(rows, F.col("zoom"), F.col("inspect"))


@query("visible_property_filter", sql(
    """SELECT id, key, value FROM (
      SELECT id, unnest(['number', 'unit', 'street', '@note', 'version', 'id', 'remark', 'empty']) AS key,
        unnest([number, unit, street, 'x', '1', id, 'null', NULL]) AS value
      FROM features WHERE theme = 'addresses')
    WHERE key IN ('number', 'unit', 'street') AND value IS NOT NULL"""))
def visible_property_filter(spark, sf_dir):
    rows = features(spark, sf_dir, "addresses").select(
        "id", "number", "unit", "street", F.lit("x").alias("@note"), F.lit("1").alias("version"),
        F.lit("null").alias("remark"), F.lit(None).cast("string").alias("empty"))
    exploded = properties_of(rows).select(
        "id", F.inline("properties")).select("id", "key", "value")
    return op.visible_property_filter(exploded)
