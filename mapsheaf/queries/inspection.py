"""Names, titles, properties, sources and computed styles."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapsheaf.functions import style
from mapsheaf.operators import inspector as op
from mapsheaf.operators import tags as tag
from mapsheaf.queries.fixture import features, sql, table
from mapsheaf.queries.registry import REGISTRY, query
from mapsheaf.sources.release import union_types


@query("json_key", sql(
    """SELECT id, coalesce(name_primary, '') AS "primary",
      CASE WHEN name_primary IS NOT NULL AND key % 2 = 0 THEN name_primary || ' X' ELSE '' END AS en
    FROM features
    UNION ALL
    SELECT 'event.' || event_id, regexp_extract(props, '"primary"\\s*:\\s*"([^"]*)"', 1),
      regexp_extract(props, '"en"\\s*:\\s*"([^"]*)"', 1) FROM events"""))
def json_key(spark, sf_dir):
    named = features(spark, sf_dir).select("id", F.to_json("names").alias("text"))
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("event."), "event_id").alias("id"), F.col("props").alias("text"))
    both = named.unionByName(events)
    return op.json_key(op.json_key(both, "text", "primary"), "text", "en").select("id", "primary", "en")


@query("localized_label", sql("\nUNION ALL\n".join(
    f"SELECT id, '{language}' AS language, {label} AS text FROM features" for language, label in (
        ("en", "CASE WHEN key % 2 = 0 AND name_primary IS NOT NULL THEN name_primary || ' X' ELSE label END"),
        ("fr", "CASE WHEN key % 2 = 1 AND name_primary IS NOT NULL THEN name_primary || ' Y' ELSE label END"),
        ("mul", "label")))))
def localized_label(spark, sf_dir):
    rows = tag.primary_label(features(spark, sf_dir).select("id", "names"))
    return union_types([
        op.localized_label(rows, language, "text").select("id", F.lit(language).alias("language"), "text")
        for language in ("en", "fr", "mul")
    ])


@query("feature_title", sql(
    """SELECT id, CASE WHEN theme = 'addresses'
      THEN concat_ws(' ', nullif(number, ''), nullif(unit, ''), nullif(street, ''))
      ELSE coalesce(label, name_primary,
        type || CASE WHEN subtype IS NOT NULL AND subtype <> type THEN ' (' || subtype || ')' ELSE '' END) END AS title
    FROM features"""))
def feature_title(spark, sf_dir):
    rows = tag.primary_label(features(spark, sf_dir)).withColumn("names", F.to_json("names"))
    return op.feature_title(rows).select("id", "title")




@query("panel_title", sql(
    """SELECT id, CASE WHEN key % 11 <> 0 AND name_primary IS NOT NULL THEN name_primary
      ELSE 'Inspector Panel' END AS title FROM features"""))
def panel_title(spark, sf_dir):
    text = F.when(F.col("key") % 11 == 0, "not json").otherwise(F.to_json("names"))
    return op.panel_title(features(spark, sf_dir).withColumn("names", text)).select("id", "title")


@query("source_links", sql(
    """SELECT id, row_number() OVER (PARTITION BY rid ORDER BY slot) - 1 AS position, property, dataset, record_id,
      CASE WHEN dataset = 'meta' THEN 'https://facebook.com/' || record_id
        WHEN dataset = 'OpenStreetMap' AND regexp_matches(record_id, '^[nwrNWR][0-9]+(@[0-9]+)?$')
        THEN 'https://www.openstreetmap.org/' || CASE lower(record_id[1]) WHEN 'n' THEN 'node' WHEN 'w' THEN 'way'
          ELSE 'relation' END || '/' || regexp_extract(record_id, '([0-9]+)', 1) END AS url
    FROM sources"""))
def source_links(spark, sf_dir):
    return op.source_links(features(spark, sf_dir)).select(
        "id", "position", "property", "dataset", "record_id", "url")


# Rendered features: some of their properties repeat or contradict where they sit.
def rendered(spark, sf_dir):
    rows = features(spark, sf_dir).select(
        "key", "theme", "type", "id", "subclass", "version", "class", "height", "has_parts", "street")
    return rows.select(
        F.when(F.col("key") % 31 == 0, "weather").otherwise(F.col("theme")).alias("source"),
        F.col("type").alias("source_layer"), "id",
        F.when(F.col("key") % 29 == 0, "places").alias("theme"),
        F.when(F.col("key") % 23 == 0, "place").alias("type"),
        F.lit("x").alias("@note"), "subclass", "version", "class", "height", "has_parts", "street",
    ).transform(op.properties_of, skip=("source", "source_layer")).select("source", "source_layer", "id", "properties")


_RENDERED_SQL = """rendered AS (
  SELECT id, rid,
    CASE WHEN key % 29 = 0 THEN 'places' WHEN key % 31 = 0 THEN 'weather' ELSE theme END AS theme,
    CASE WHEN key % 23 = 0 THEN 'place' ELSE type END AS type,
    subclass, version, class, height, has_parts, street FROM features)"""


@query("feature_entity", sql(
    """SELECT id, theme, type, theme <> 'weather' AS known_theme,
      concat_ws('|', 'theme=' || theme, 'type=' || type, 'id=' || id, '@note=x', 'subclass=' || subclass,
        'version=' || version, 'class=' || class, 'height=' || CAST(height AS VARCHAR),
        'has_parts=' || CAST(has_parts AS VARCHAR), 'street=' || street) AS entity
    FROM rendered""", _RENDERED_SQL))
def feature_entity(spark, sf_dir):
    entries = F.transform("entity", lambda entry: F.concat(entry["key"], F.lit("="), entry["value"]))
    return op.feature_entity(rendered(spark, sf_dir)).select(
        "id", "theme", "type", "known_theme", F.array_join(entries, "|").alias("entity"))


@query("property_rows", sql(
    """SELECT id, key, value, indented, row_number() OVER (PARTITION BY rid ORDER BY slot) - 1 AS position
    FROM (SELECT id, rid, unnest(['theme', 'type', 'id', 'version', 'class', 'subclass', 'height', 'has_parts', 'street', 'subclass']) AS key,
        unnest([theme, type, id, CAST(version AS VARCHAR), class, CASE WHEN class IS NOT NULL THEN subclass END,
          CAST(height AS VARCHAR), CAST(has_parts AS VARCHAR), street, CASE WHEN class IS NULL THEN subclass END]) AS value,
        unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS slot,
        unnest([FALSE, FALSE, FALSE, FALSE, FALSE, TRUE, FALSE, FALSE, FALSE, FALSE]) AS indented
      FROM rendered) WHERE value IS NOT NULL""", _RENDERED_SQL))
def property_rows(spark, sf_dir):
    return op.property_rows(op.feature_entity(rendered(spark, sf_dir))).select(
        "id", "key", "value", "indented", "position")


@query("property_values", sql(
    """SELECT id, key, row_number() OVER (PARTITION BY rid, key ORDER BY slot) - 1 AS position, member, text FROM (
      SELECT rid, id, 'names' AS key, unnest([0, 1, 2]) AS slot, unnest(['primary', 'common', 'rules']) AS member,
        unnest([name_primary, '{"' || CASE WHEN key % 2 = 0 THEN 'en":"' || name_primary || ' X' ELSE 'fr":"' || name_primary || ' Y' END || '"}',
          CASE WHEN key % 7 = 0 THEN '[{"between":[0,0.5]}]' END]) AS text
      FROM features WHERE name_primary IS NOT NULL
      UNION ALL
      SELECT rid, id, 'categories', unnest([0, 1]), unnest(['primary', 'alternate']), unnest([category, 'other'])
      FROM features WHERE category IS NOT NULL
      UNION ALL
      SELECT rid, id, 'cartography', unnest([0, 1]), unnest(['min_zoom', 'max_zoom']),
        unnest([CAST(draw_from AS VARCHAR), CAST(draw_from + 5 AS VARCHAR)])
      FROM features WHERE draw_from IS NOT NULL
      UNION ALL
      SELECT rid, id, 'sources', slot, NULL, '{"dataset":"' || dataset || '","property":"' || property || '"'
        || coalesce(',"record_id":"' || record_id || '"', '') || '}' FROM sources
      UNION ALL
      SELECT rid, id, 'subtype', 0, NULL, subtype FROM features WHERE subtype IS NOT NULL)
    WHERE text IS NOT NULL"""))
def property_values(spark, sf_dir):
    nested = features(spark, sf_dir).select("id", "names", "categories", "cartography", "sources", "subtype")
    rows = op.properties_of(nested, skip=("id", "@name")).select("id", F.inline("properties"))
    return op.property_values(rows)


@query("property_tree", sql(
    """SELECT id, key, row_number() OVER (PARTITION BY rid, key ORDER BY slot) - 1 AS position, path, text FROM (
      SELECT rid, id, 'names' AS key, unnest([0, 1, 2, 3]) AS slot,
        unnest(['primary', CASE WHEN key % 2 = 0 THEN 'common.en' ELSE 'common.fr' END, 'rules.0.between.0', 'rules.0.between.1']) AS path,
        unnest([name_primary, name_primary || CASE WHEN key % 2 = 0 THEN ' X' ELSE ' Y' END,
          CASE WHEN key % 7 = 0 THEN '0.0' END, CASE WHEN key % 7 = 0 THEN '0.5' END]) AS text
      FROM features WHERE name_primary IS NOT NULL
      UNION ALL
      SELECT rid, id, 'categories', unnest([0, 1]), unnest(['primary', 'alternate.0']), unnest([category, 'other'])
      FROM features WHERE category IS NOT NULL
      UNION ALL
      SELECT rid, id, 'cartography', unnest([0, 1]), unnest(['min_zoom', 'max_zoom']),
        unnest([CAST(draw_from AS VARCHAR), CAST(draw_from + 5 AS VARCHAR)])
      FROM features WHERE draw_from IS NOT NULL
      UNION ALL
      SELECT rid, id, 'sources', nth * 3 + unnest([0, 1, 2]), nth || '.' || unnest(['property', 'dataset', 'record_id']),
        unnest([property, dataset, record_id])
      FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY slot) - 1 AS nth FROM sources)
      UNION ALL
      SELECT rid, id, 'subtype', 0, NULL, subtype FROM features WHERE subtype IS NOT NULL)
    WHERE text IS NOT NULL"""))
def property_tree(spark, sf_dir):
    nested = features(spark, sf_dir).select("id", "names", "categories", "cartography", "sources", "subtype")
    rows = op.properties_of(nested, skip=("id", "@name")).select("id", F.inline("properties"))
    return op.property_tree(rows)


@query("property_walk", REGISTRY["property_tree"].sql)
def property_walk(spark, sf_dir):
    # The same rows by a recursive query.
    nested = features(spark, sf_dir).select("id", "names", "categories", "cartography", "sources", "subtype")
    rows = op.properties_of(nested, skip=("id", "@name")).select("id", F.inline("properties"))
    return op.property_walk(rows)


@query("url_flags",
       """WITH listed AS (
         SELECT page_id, url AS value, [url, CASE WHEN page_id % 3 = 0 THEN 'no address' ELSE url END] AS links FROM pages
         UNION ALL SELECT -1 - doc_id, text, [] FROM documents)
       SELECT page_id, regexp_matches(value, '(?is)^\\s*https?:[/\\\\]*[^/\\\\?#\\s@:<>^|%]+([/\\\\?#:].*)?$') AS is_url,
         len(links) > 0 AND len(list_filter(links, lambda x: NOT x LIKE 'http%')) = 0 AS all_urls
       FROM listed""")
def url_flags(spark, sf_dir):
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", url.alias("value"),
        F.array(url, F.when(F.col("page_id") % 3 == 0, "no address").otherwise(url)).alias("links"))
    texts = table(spark, sf_dir, "documents").select(
        (-1 - F.col("doc_id")).alias("page_id"), F.col("text").alias("value"),
        F.array().cast("array<string>").alias("links"))
    return op.url_flags(pages.unionByName(texts), "value", "links").select("page_id", "is_url", "all_urls")


@query("type_titles", sql(
    """SELECT id, CASE type WHEN 'land_use' THEN 'Land Use' WHEN 'land_cover' THEN 'Land Cover'
      WHEN 'building_part' THEN 'Building Part' WHEN 'division_area' THEN 'Division Area'
      WHEN 'division_boundary' THEN 'Division Boundary' ELSE upper(type[1]) || type[2:] END AS title,
      list_aggregate(list_transform(string_split(category, '_'), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS category_title
    FROM features"""))
def type_titles(spark, sf_dir):
    rows = features(spark, sf_dir).select("id", "type", F.col("categories.primary").alias("category"))
    return op.type_titles(op.type_titles(rows), "category", "category_title").select("id", "title", "category_title")


@query("building_extrusion", sql(
    """SELECT id, CASE WHEN min_height >= 0 THEN min_height ELSE 0 END AS base, coalesce(height, 0) AS top
    FROM features WHERE theme = 'buildings'"""))
def building_extrusion(spark, sf_dir):
    return op.building_extrusion(features(spark, sf_dir, "buildings")).select("id", "base", "top")


_WIDTH_SQL = """CASE WHEN zoom <= 3 THEN w3 WHEN zoom <= 8 THEN w3 + (w8 - w3) * ((zoom - 3) / CAST(5 AS DOUBLE))
  WHEN zoom <= 12 THEN w8 + (w12 - w8) * ((zoom - 8) / CAST(4 AS DOUBLE))
  WHEN zoom <= 16 THEN w12 + (w16 - w12) * ((zoom - 12) / CAST(4 AS DOUBLE)) ELSE w16 END"""


def _widths(zoom: int, country, region, county, other) -> str:
    return (f"CAST(CASE WHEN subtype IN ('country', 'dependency') THEN {country} "
            f"WHEN subtype IN ('region', 'macroregion') THEN {region} "
            f"WHEN subtype IN ('county', 'macrocounty') THEN {county} ELSE {other} END AS DOUBLE) AS w{zoom}")


@query("style_interpolate", sql(
    f"""SELECT id, 'width' AS style, {_WIDTH_SQL} AS styled FROM (
      SELECT id, CAST(key % 20 AS DOUBLE) AS zoom, {_widths(3, 1, 0.7, 0.5, 0.1)},
        {_widths(8, 1.25, 0.85, 0.65, 0.15)}, {_widths(12, 1.75, 1.25, 0.9, 0.2)}, {_widths(16, 2, 1.5, 1, 0.2)}
      FROM features WHERE theme = 'divisions')
    UNION ALL
    SELECT id, 'icon', CASE WHEN confidence <= 0.5 THEN 0.2::DOUBLE
      WHEN confidence <= 0.7 THEN 0.2::DOUBLE + (0.3::DOUBLE - 0.2::DOUBLE) * ((confidence - 0.5::DOUBLE) / (0.7::DOUBLE - 0.5::DOUBLE))
      WHEN confidence <= 0.9 THEN 0.3::DOUBLE + (0.4::DOUBLE - 0.3::DOUBLE) * ((confidence - 0.7::DOUBLE) / (0.9::DOUBLE - 0.7::DOUBLE))
      WHEN confidence <= 1 THEN 0.4::DOUBLE + (0.5::DOUBLE - 0.4::DOUBLE) * ((confidence - 0.9::DOUBLE) / (1 - 0.9::DOUBLE))
      ELSE 0.5 END FROM features WHERE theme = 'places'"""))
def style_interpolate(spark, sf_dir):
    zoom = (F.col("key") % 20).cast("double")
    borders = op.style_interpolate(
        features(spark, sf_dir, "divisions"), zoom, style.boundary_width_stops(F.col("subtype")))
    icons = op.style_interpolate(features(spark, sf_dir, "places"), "confidence", style.PLACE_ICON_STOPS)
    return union_types([
        borders.select("id", F.lit("width").alias("style"), "styled"),
        icons.select("id", F.lit("icon").alias("style"), "styled"),
    ])
