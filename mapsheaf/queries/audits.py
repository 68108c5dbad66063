"""Audits of the features against small tile and schema specs."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapsheaf.operators import audit as op
from mapsheaf.operators.tiling import observed_fields
from mapsheaf.plans.rules import RULES, rule_references
from mapsheaf.queries.fixture import features, sql, values_sql
from mapsheaf.queries.registry import query
from mapsheaf.queries.tiles import ZOOMED, zoomed
from mapsheaf.session import reliable_checkpoint
from mapsheaf.sources.release import union_types

# A tile spec with gaps: layers, fields and zooms that the features do not keep to.
_LAYERS = {
    ("addresses", "address"): (14, ("id", "number", "street", "sources", "version")),
    ("base", "land"): (5, ("id", "subtype", "class", "names", "sources", "version")),
    ("base", "land_cover"): (0, ("id", "subtype", "sources", "version")),
    ("base", "land_use"): (6, ("id", "subtype", "class", "names", "sources", "version")),
    ("base", "water"): (4, ("id", "subtype", "is_intermittent", "sources", "version")),
    ("buildings", "building"): (5, ("id", "subtype", "height", "has_parts", "sources", "version")),
    ("divisions", "division"): (4, ("id", "subtype", "population", "names", "sources", "version")),
    ("divisions", "division_area"): (0, ("id", "subtype", "class", "names", "sources", "version")),
    ("places", "place"): (14, ("id", "names", "categories", "sources", "version")),
    ("transportation", "segment"): (5, ("id", "subtype", "class", "sources", "version")),
}
TILESPEC = [
    (theme, layer, field, low) for (theme, layer), (low, fields) in _LAYERS.items() for field in fields
]
TILESPEC_COLUMNS = ["theme", "layer", "field", "minzoom"]
TILESPEC_SQL = values_sql("tilespec", TILESPEC_COLUMNS, TILESPEC)

# Enums that leave out some of the values the features have.
ENUMS = [
    (theme, type_, kind, value)
    for (theme, type_, kind), values in {
        ("base", "land", "subtypes"): ("land", "glacier", "forest", "sand"),
        ("base", "land", "classes"): ("land", "cliff", "volcano"),
        ("base", "water", "subtypes"): ("ocean", "river", "lake", "canal"),
        ("base", "land_use", "classes"): ("park", "garden", "pitch", "college", "hospital", "zoo"),
        ("base", "infrastructure", "subtypes"): ("airport", "pier", "bridge"),
        ("divisions", "division", "subtypes"): ("country", "region", "county", "locality", "borough"),
        ("transportation", "segment", "subtypes"): ("road", "rail", "water"),
        ("transportation", "segment", "road_classes"): (
            "motorway", "trunk", "primary", "secondary", "tertiary", "residential", "bus_guideway"),
        ("transportation", "segment", "rail_classes"): ("subway", "tram"),
    }.items() for value in values
]
ENUM_COLUMNS = ["theme", "type", "kind", "value"]
ENUM_SQL = values_sql("enums", ENUM_COLUMNS, ENUMS)


def tilespec(spark):
    return spark.createDataFrame(TILESPEC, "theme string, layer string, field string, minzoom int")


def enums(spark):
    return spark.createDataFrame(ENUMS, "theme string, type string, kind string, value string")


_ISSUE = ", ".join(op.ISSUE_COLUMNS)

_LAYER_ISSUES = """SELECT 'error' AS severity, 'tile-layer' AS "check", theme, type, type AS subject, count(*) AS features
  FROM features f WHERE NOT EXISTS (SELECT 1 FROM tilespec t WHERE t.theme = f.theme AND t.layer = f.type)
  GROUP BY theme, type"""


@query("audit_missing_layers", sql(_LAYER_ISSUES, TILESPEC_SQL))
def audit_missing_layers(spark, sf_dir):
    return op.audit_missing_layers(op.observed_types(features(spark, sf_dir)), tilespec(spark))


_FIELDS = ["id", "subtype", "class", "subclass", "confidence", "population", "height", "min_height",
           "depth", "is_intermittent", "has_parts", "number", "unit", "street", "version"]
_FIELD_SQL = "fields AS (\n" + "\nUNION ALL\n".join(
    f"SELECT theme, type, '{name}' AS field, count({column}) AS features FROM features GROUP BY ALL"
    for name, column in [*((c, c) for c in _FIELDS), ("names", "name_primary"),
                         ("categories", "category"), ("sources", "theme"), ("@name", "label")]
) + ")"
_FIELD_ISSUES = """SELECT 'error' AS severity, 'tile-field' AS "check", theme, type, field AS subject, features
  FROM fields f WHERE features > 0
    AND EXISTS (SELECT 1 FROM tilespec t WHERE t.theme = f.theme AND t.layer = f.type)
    AND NOT EXISTS (SELECT 1 FROM tilespec t WHERE t.theme = f.theme AND t.layer = f.type AND t.field = f.field)
    AND NOT (type = 'building' AND field = 'min_height')"""


def _named(rows):
    return rows.withColumn("@name", F.when(
        ~F.exists(F.coalesce("names.rules", F.array()), lambda rule: rule["between"].isNotNull()),
        F.col("names.primary")))


def _field_issues(spark, observed):
    allowed = spark.createDataFrame(
        [("buildings", "building", "min_height")], "theme string, type string, field string")
    return op.audit_missing_fields(observed, tilespec(spark), allowed)


@query("audit_missing_fields", sql(_FIELD_ISSUES, TILESPEC_SQL, _FIELD_SQL))
def audit_missing_fields(spark, sf_dir):
    rows = _named(features(spark, sf_dir)).select(
        "theme", "type", *_FIELDS, "names", "categories", "sources", "@name")
    return _field_issues(spark, observed_fields(rows))


_VALUE_SQL = """observed AS (
  SELECT theme, type, subtype AS value FROM features WHERE subtype IS NOT NULL
  UNION ALL SELECT theme, type, class FROM features WHERE class IS NOT NULL)"""
_VALUE_ISSUES = """SELECT 'warn' AS severity, 'schema-value' AS "check", theme, type, value AS subject, count(*) AS features
  FROM observed o WHERE EXISTS (SELECT 1 FROM enums e WHERE e.theme = o.theme AND e.type = o.type)
    AND NOT EXISTS (SELECT 1 FROM enums e WHERE e.theme = o.theme AND e.type = o.type AND e.value = o.value)
  GROUP BY theme, type, value"""


@query("audit_bad_values", sql(_VALUE_ISSUES, ENUM_SQL, _VALUE_SQL))
def audit_bad_values(spark, sf_dir):
    return op.audit_bad_values(op.observed_values(features(spark, sf_dir)), enums(spark))


_ZOOM_ISSUES = """SELECT 'warn' AS severity, 'zoom-range' AS "check", z.theme, z.type,
    CAST(min_zoom AS VARCHAR) AS subject, count(*) AS features
  FROM zoomed z JOIN (SELECT theme, layer, min(minzoom) AS low FROM tilespec GROUP BY ALL) t
    ON t.theme = z.theme AND t.layer = z.type
  WHERE min_zoom < low GROUP BY z.theme, z.type, min_zoom"""


def _zoom_issues(spark, sf_dir):
    return op.audit_zoom_range(op.observed_zooms(zoomed(spark, sf_dir)), tilespec(spark))


@query("audit_zoom_range", sql(_ZOOM_ISSUES, ZOOMED, TILESPEC_SQL))
def audit_zoom_range(spark, sf_dir):
    return _zoom_issues(spark, sf_dir)


# What a feature says of itself: some kinds of keys are told wrongly, or not at all.
_DECLARED = {
    "declared_theme": "CASE WHEN key % 97 = 0 THEN 'places' WHEN key % 89 <> 0 THEN theme END",
    "declared_type": "CASE WHEN key % 83 = 0 THEN 'place' WHEN key % 79 = 0 THEN '' ELSE type END",
}
_METADATA_ISSUES = f"""SELECT 'warn' AS severity, 'metadata' AS "check", theme, type, part || ':' || declared AS subject,
    count(*) AS features
  FROM (SELECT theme, type, 'theme' AS part, {_DECLARED['declared_theme']} AS declared, theme AS placed FROM features
    UNION ALL SELECT theme, type, 'type', {_DECLARED['declared_type']}, type FROM features)
  WHERE declared <> '' AND declared <> placed GROUP BY theme, type, part, declared"""


def _metadata_issues(spark, sf_dir):
    rows = features(spark, sf_dir)
    return op.audit_metadata(rows.withColumns({name: F.expr(e) for name, e in _DECLARED.items()}))


@query("audit_metadata", sql(_METADATA_ISSUES))
def audit_metadata(spark, sf_dir):
    return _metadata_issues(spark, sf_dir)


_ALL_ISSUES = "issues AS (\n" + "\nUNION ALL\n".join(
    f"({part})" for part in (_LAYER_ISSUES, _FIELD_ISSUES, _VALUE_ISSUES, _ZOOM_ISSUES, _METADATA_ISSUES)) + ")"


@query("audit_counts", sql(
    'SELECT severity, "check", count(*) AS issues FROM issues GROUP BY ROLLUP (severity, "check")',
    ZOOMED, TILESPEC_SQL, ENUM_SQL, _FIELD_SQL, _VALUE_SQL, _ALL_ISSUES))
def audit_counts(spark, sf_dir):
    # One pass over the features; the checks read its few rows.
    rows = _named(zoomed(spark, sf_dir)).withColumns({name: F.expr(e) for name, e in _DECLARED.items()})
    seen = reliable_checkpoint(op.observations(rows, (*_FIELDS, "names", "categories", "sources", "@name")))
    return op.audit_counts(union_types([
        op.audit_missing_layers(op.observed_types(seen), tilespec(spark)),
        _field_issues(spark, op.observed_fields(seen)),
        op.audit_bad_values(op.observed_values(seen), enums(spark)),
        op.audit_zoom_range(op.observed_zooms(seen), tilespec(spark)),
        op.audit_metadata(seen),
    ]))


# Enums that grow with the data: every value the features of a type have.
_SEEN_ENUM_SQL = """seen_enums AS (
  SELECT DISTINCT theme, type, 'subtypes' AS kind, subtype AS value FROM features WHERE subtype IS NOT NULL
  UNION ALL
  SELECT DISTINCT theme, type, CASE subtype WHEN 'road' THEN 'road_classes' WHEN 'rail' THEN 'rail_classes'
    ELSE 'classes' END, class FROM features WHERE class IS NOT NULL)"""


def _seen_enums(rows):
    class_kind = (
        F.when(F.col("subtype") == "road", "road_classes")
        .when(F.col("subtype") == "rail", "rail_classes").otherwise("classes"))
    kinds = F.array(
        F.struct(F.lit("subtypes").alias("kind"), F.col("subtype").alias("value")),
        F.struct(class_kind.alias("kind"), F.col("class").alias("value")))
    return rows.select("theme", "type", F.inline(kinds)).where("value IS NOT NULL").distinct()


@query("enum_values", sql("SELECT DISTINCT theme, type, value FROM seen_enums", _SEEN_ENUM_SQL))
def enum_values(spark, sf_dir):
    return op.enum_values(_seen_enums(features(spark, sf_dir)))


# Values that the explore rules name, and how many features have each value seen.
_USED = sorted({
    (rule.theme, rule.type, value)
    for rule in RULES["explore"] if rule.test for attribute, _, values in rule.test.mentions
    if attribute in ("subtype", "class") for value in values if isinstance(value, str)})
_USED_SQL = values_sql("used", ["theme", "type", "value"], _USED)


def _used(spark):
    return op.used_values(rule_references(spark, "explore"))


@query("styled_values", sql(
    """SELECT theme, type, value, styled, coalesce(features, 0) AS features FROM (
      SELECT DISTINCT theme, type, value,
        EXISTS (SELECT 1 FROM used u WHERE u.theme = e.theme AND u.type = e.type AND u.value = e.value) AS styled
      FROM seen_enums e)
    LEFT JOIN (SELECT theme, type, value, count(*) AS features FROM observed GROUP BY ALL) USING (theme, type, value)""",
    _SEEN_ENUM_SQL, _USED_SQL, _VALUE_SQL))
def styled_values(spark, sf_dir):
    rows = features(spark, sf_dir)
    counts = op.observed_values(rows).groupBy("theme", "type", "value").agg(F.sum("features").alias("features"))
    marked = op.styled_values(_seen_enums(rows), _used(spark))
    return marked.join(counts, ["theme", "type", "value"], "left").fillna(0, ["features"])


_COVERED_SQL = """covered AS (
  SELECT e.*, EXISTS (SELECT 1 FROM used u WHERE u.theme = e.theme AND u.type = e.type AND u.value = e.value) AS is_styled
  FROM seen_enums e)"""


@query("style_coverage", sql(
    """SELECT theme, type, kind, count(*) AS total, count(*) FILTER (is_styled) AS styled,
      coalesce(string_agg(value, ',' ORDER BY value) FILTER (is_styled), '') AS styled_values,
      coalesce(string_agg(value, ',' ORDER BY value) FILTER (NOT is_styled), '') AS unstyled_values,
      CAST(floor(count(*) FILTER (is_styled) * 100 / count(*) + 0.5) AS BIGINT) AS percent
    FROM covered GROUP BY theme, type, kind""", _SEEN_ENUM_SQL, _USED_SQL, _COVERED_SQL))
def style_coverage(spark, sf_dir):
    return op.style_coverage(_seen_enums(features(spark, sf_dir)), _used(spark))


@query("style_coverage_total", sql(
    """SELECT count(*) AS total, count(*) FILTER (is_styled) AS styled,
      CAST(floor(count(*) FILTER (is_styled) * 100 / count(*) + 0.5) AS BIGINT) AS percent
    FROM covered""", _SEEN_ENUM_SQL, _USED_SQL, _COVERED_SQL))
def style_coverage_total(spark, sf_dir):
    return op.style_coverage_total(_seen_enums(features(spark, sf_dir)), _used(spark))
