"""Lookups by id, link and name."""

from __future__ import annotations

from pyspark.sql import functions as F

from mapsheaf.model import LOOKUP_TYPE_ORDER
from mapsheaf.operators import indexes
from mapsheaf.operators import lookup as op
from mapsheaf.queries.fixture import box, features, sql, table, values_sql, rules_sql
from mapsheaf.queries.registry import query
from mapsheaf.queries.catalog import release_root
from mapsheaf.session import new_dir
from mapsheaf.sources.release import scan_release

_ORDER_SQL = values_sql("type_order", ["type", "place"], [(t, n) for n, t in enumerate(LOOKUP_TYPE_ORDER)])

# Requested ids: one per customer of a way or a base feature, some of which do not exist.
_IDS_SQL = """ids AS (
  SELECT 'way.' || CAST((c_custkey * 13) % 20000 AS STRING) AS id FROM customer
  UNION ALL SELECT 'base.' || CAST((c_custkey * 17) % 12000 AS STRING) FROM customer)"""


def requested_ids(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.selectExpr("'way.' || CAST((c_custkey * 13) % 20000 AS STRING) AS id").unionAll(
        customers.selectExpr("'base.' || CAST((c_custkey * 17) % 12000 AS STRING) AS id"))


# Both the feature and, for some, a copy of it under another type.
_COPIES_SQL = """copies AS (
  SELECT id, type, subtype, xmin, ymin FROM features
  UNION ALL SELECT id, 'division_area', 'copy', xmin, ymin FROM features WHERE theme IN ('transportation', 'base'))"""


@query("feature_lookup", sql(
    """SELECT id, type, subtype FROM (
      SELECT c.id, c.type, c.subtype, row_number() OVER (PARTITION BY c.id ORDER BY o.place, xmin, ymin) AS nth
      FROM copies c JOIN type_order o ON o.type = c.type WHERE c.id IN (SELECT id FROM ids))
    WHERE nth = 1""", _ORDER_SQL, _IDS_SQL, _COPIES_SQL))
def feature_lookup(spark, sf_dir):
    rows = features(spark, sf_dir).select("id", "type", "subtype", "bbox")
    copies = features(spark, sf_dir, "transportation", "base").select(
        "id", F.lit("division_area").alias("type"), F.lit("copy").alias("subtype"), "bbox")
    found = op.feature_lookup(rows.unionByName(copies), requested_ids(spark, sf_dir), ["type", "subtype"])
    return found.select("id", "type", "subtype")


_indexes: dict[tuple[str, str, str], str] = {}


def _index(spark, sf_dir, name, write):
    """Where an index lies; written once per session and input."""
    known = (spark.sparkContext.applicationId, sf_dir, name)
    if known not in _indexes:
        out = new_dir(spark, name)
        write(out)
        _indexes[known] = out
    return _indexes[known]


@query("feature_lookup_indexed", sql(
    "SELECT id, type, subtype FROM features WHERE id IN (SELECT id FROM ids)", _IDS_SQL))
def feature_lookup_indexed(spark, sf_dir):
    root = release_root(spark, sf_dir)
    index = _index(spark, sf_dir, "ids", lambda out: indexes.write_id_index(scan_release(spark, root), out))
    return indexes.indexed_lookup(
        spark, root, index, requested_ids(spark, sf_dir), columns=["type", "subtype"]).select("id", "type", "subtype")


# A link per order: with and without position, layers, mode and a feature that exists.
_LINK = """'https://maps.example.org/?' ||
  CASE o_orderkey % 3 WHEN 0 THEN 'mode=inspect&' ELSE '' END ||
  CASE o_orderkey % 4 WHEN 0 THEN 'layers=land%2Coceans&' WHEN 1 THEN 'layers=rail&' ELSE '' END ||
  CASE o_orderkey % 5 WHEN 0 THEN 'feature=transportation.segment.way.' || CAST(o_orderkey % 700 AS STRING)
    WHEN 1 THEN 'feature=places.place' WHEN 2 THEN 'feature=places.place.place.' || CAST(o_custkey AS STRING)
    ELSE 'x=1' END ||
  CASE o_orderkey % 6 WHEN 0 THEN '#12.5/31.25/35.5' WHEN 1 THEN '#9/a/2' WHEN 2 THEN '#4/10/-20/0' WHEN 3 THEN '#7/1'
    ELSE '' END"""


def links(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS link_id", f"{_LINK} AS url")


@query("view_link_restore", sql(
    """SELECT link_id, CASE WHEN link_id % 3 = 0 THEN 'inspect' ELSE 'explore' END AS mode,
      CASE link_id % 4 WHEN 0 THEN 'land|oceans' WHEN 1 THEN 'rail' END AS layers,
      CASE link_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE (SELECT count(DISTINCT item) FROM rules
        WHERE rules.mode = CASE WHEN link_id % 3 = 0 THEN 'inspect' ELSE 'explore' END AND (rules.mode = 'inspect' OR item NOT IN
          ('place-all-circle', 'place-all-density-circle', 'building-footprint', 'building-part-footprint', 'address'))) END AS items,
      CASE link_id % 6 WHEN 0 THEN 12.5 WHEN 2 THEN 4 END::DOUBLE AS zoom,
      CASE link_id % 6 WHEN 0 THEN 31.25 WHEN 2 THEN 10 END::DOUBLE AS latitude,
      CASE link_id % 6 WHEN 0 THEN 35.5 WHEN 2 THEN -20 END::DOUBLE AS longitude,
      wanted.theme, wanted.type, wanted.id, f.subtype, f.id IS NOT NULL AS found
    FROM (SELECT o_orderkey AS link_id,
        CASE o_orderkey % 5 WHEN 0 THEN 'transportation' WHEN 2 THEN 'places' END AS theme,
        CASE o_orderkey % 5 WHEN 0 THEN 'segment' WHEN 2 THEN 'place' END AS type,
        CASE o_orderkey % 5 WHEN 0 THEN 'way.' || (o_orderkey % 700) WHEN 2 THEN 'place.' || o_custkey END AS id
      FROM orders) wanted
    LEFT JOIN features f ON f.theme = wanted.theme AND f.type = wanted.type AND f.id = wanted.id""", rules_sql("explore", "inspect")))
def view_link_restore(spark, sf_dir):
    rows = features(spark, sf_dir).select("theme", "type", "id", "subtype", "bbox")
    return op.view_link_restore(links(spark, sf_dir), rows).select(
        "link_id", "mode", F.concat_ws("|", "layers").alias("layers"), F.size("items").cast("long").alias("items"), "zoom", "latitude", "longitude",
        "theme", "type", "id", F.col("feature.subtype").alias("subtype"),
        F.col("feature").isNotNull().alias("found")
    ).withColumn("layers", F.nullif("layers", F.lit("")))


# A query per customer: the start of a name, in changing case.
_QUERY = """CASE c_custkey % 6 WHEN 0 THEN 'ROAD ' || CAST(c_custkey % 500 AS STRING) WHEN 1 THEN 'ro'
  WHEN 2 THEN 'Red' WHEN 3 THEN 'sUp ' || CAST(c_custkey % 9 AS STRING) WHEN 4 THEN 'r' ELSE 'small b' END"""


def name_queries(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS query_id", f"{_QUERY} AS text")


_SEARCH_SQL = f"""queries AS (SELECT c_custkey AS query_id, {_QUERY} AS text FROM customer),
texts AS (SELECT DISTINCT lower(text) AS prefix FROM queries WHERE length(text) >= 2),
ranked AS (
  SELECT prefix, id, label AS name, subtype, row_number() OVER (PARTITION BY prefix ORDER BY lower(label), label, id) AS position
  FROM texts JOIN features ON starts_with(lower(label), prefix)),
results AS (
  SELECT query_id, text, id, name, subtype, position FROM queries JOIN ranked ON prefix = lower(text) WHERE position <= 6)"""

_RESULT = ["query_id", "text", "position", "id", "name"]


@query("name_search", sql(f"SELECT {', '.join(_RESULT)} FROM results", _SEARCH_SQL))
def name_search(spark, sf_dir):
    rows = features(spark, sf_dir).select("id", "theme", "type", "subtype", "names")
    return op.name_search(rows, name_queries(spark, sf_dir)).select(*_RESULT)


@query("name_search_country", sql(
    f"SELECT {', '.join(_RESULT)} FROM results WHERE subtype = 'country'", _SEARCH_SQL))
def name_search_country(spark, sf_dir):
    rows = features(spark, sf_dir).select("id", "theme", "type", "subtype", "names")
    return op.name_search(rows, name_queries(spark, sf_dir), "country").select(*_RESULT)


# A query per customer: one or two words of a name, some with a letter changed, lost or added.
_FUZZY = """CASE c_custkey % 7 WHEN 0 THEN 'Raod' WHEN 1 THEN 'roed' WHEN 2 THEN 'rod ' || CAST(c_custkey % 90 AS STRING)
  WHEN 3 THEN CAST(c_custkey % 300 AS STRING) || ' ROAD' WHEN 4 THEN 'smalll' WHEN 5 THEN 'bue' ELSE 'r' || CAST(c_custkey % 9 AS STRING) END"""

_FUZZY_SQL = f"""queries AS (SELECT c_custkey AS query_id, {_FUZZY} AS text FROM customer),
asked AS (SELECT text, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'))) AS w FROM (SELECT DISTINCT text FROM queries)),
names AS (SELECT DISTINCT label FROM features WHERE label IS NOT NULL),
held AS (SELECT label, unnest(list_distinct(regexp_extract_all(lower(label), '[\\p{{L}}\\p{{N}}]+'))) AS word FROM names),
words AS (SELECT DISTINCT word FROM held),
near AS (SELECT w, word, levenshtein(w, word) AS d FROM (SELECT DISTINCT w FROM asked), words
  WHERE levenshtein(w, word) <= CASE WHEN length(w) > 1 THEN 1 ELSE 0 END),
matched AS (SELECT text, label, w, min(d) AS d FROM asked JOIN near USING (w) JOIN held USING (word) GROUP BY ALL),
whole AS (SELECT text, label, sum(d) AS errors FROM matched JOIN (SELECT text, count(*) AS n FROM asked GROUP BY text) USING (text)
  GROUP BY text, label HAVING count(*) = max(n)),
best AS (SELECT text, id, label, errors, row_number() OVER (PARTITION BY text ORDER BY errors, lower(label), label, id) AS position
  FROM whole JOIN features USING (label))"""


@query("name_search_indexed", sql(
    """SELECT query_id, text, position, id, label AS name, CAST(errors AS INTEGER) AS errors
    FROM queries JOIN best USING (text) WHERE position <= 6""", _FUZZY_SQL))
def name_search_indexed(spark, sf_dir):
    rows = features(spark, sf_dir).select("id", "theme", "type", "subtype", "names")
    index = _index(spark, sf_dir, "names", lambda out: indexes.write_name_index(rows, out))
    asked = table(spark, sf_dir, "customer").selectExpr("c_custkey AS query_id", f"{_FUZZY} AS text")
    return indexes.indexed_search(spark, index, asked).select("query_id", "text", "position", "id", "name", "errors")


_BIG = "(abs(xmax - xmin) > 0.001 AND abs(ymax - ymin) > 0.001)"
_POINT = "(lon IS NOT NULL AND lat IS NOT NULL)"
_HITS_SQL = """hits AS (
  SELECT id, CASE WHEN key % 5 <> 0 THEN xmin END AS xmin, CASE WHEN key % 5 <> 0 THEN xmax END AS xmax,
    CASE WHEN key % 5 <> 0 THEN ymin END AS ymin, CASE WHEN key % 5 <> 0 THEN ymax END AS ymax,
    CASE WHEN key % 3 <> 0 THEN xmin END AS lon, CASE WHEN key % 3 <> 0 THEN ymin END AS lat FROM features)"""


def _viewport_sql(mode: str, steps: list[tuple[str, str]]) -> str:
    outcome = {
        "fit": ("'fit'", "NULL", "NULL", "14.5"),
        "middle": ("'center'", "(xmin + xmax) / 2", "(ymin + ymax) / 2", "16"),
        "point": ("'center'", "lon", "lat", "14.5"),
        "country": ("'center'", "lon", "lat", "4"),
    }
    names = ("action", "center_lon", "center_lat", "view_zoom")
    columns = ", ".join(
        "CASE " + " ".join(f"WHEN {test} THEN {outcome[go][n]}" for test, go in steps) + f" END AS {name}"
        for n, name in enumerate(names))
    return f"SELECT id, '{mode}' AS mode, {columns} FROM hits"


@query("lookup_viewport", sql(
    "SELECT id, mode, action, center_lon, center_lat, CAST(view_zoom AS DOUBLE) AS view_zoom FROM ("
    + "\nUNION ALL\n".join([
        _viewport_sql("id", [(_BIG, "fit"), ("xmin IS NOT NULL", "middle"), (_POINT, "point")]),
        _viewport_sql("country", [(_POINT, "country"), (_BIG, "fit")]),
        _viewport_sql("locality", [(_BIG, "fit"), (_POINT, "point")]),
    ]) + ")", _HITS_SQL))
def lookup_viewport(spark, sf_dir):
    rows = features(spark, sf_dir)
    boxed, pointed = F.col("key") % 5 != 0, F.col("key") % 3 != 0
    bbox = F.col("bbox")
    hits = rows.select(
        "id",
        F.when(boxed, box(bbox["xmin"], bbox["ymin"], bbox["xmax"], bbox["ymax"])).alias("box"),
        F.when(pointed, bbox["xmin"]).alias("lon"), F.when(pointed, bbox["ymin"]).alias("lat"))
    modes = [
        op.lookup_viewport(hits, mode).select(
            "id", F.lit(mode).alias("mode"), "action", "center_lon", "center_lat", "view_zoom")
        for mode in ("id", "country", "locality")
    ]
    return modes[0].unionByName(modes[1]).unionByName(modes[2])
