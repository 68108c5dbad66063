"""Features made from the driver's tables, the same way in Spark and in SQL.

Each table feeds one theme; positions, kinds and values follow from its keys by
integer arithmetic. ``FLAT`` holds the columns as SQL expressions that both sides
read alike; nested columns are put on top in each dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.plans.rules import RULES
from mapsheaf.session import ship_package

COLUMNS = {
    "key": "BIGINT", "theme": "STRING", "type": "STRING", "id": "STRING", "geom_type": "STRING",
    "lon_m": "BIGINT", "lat_m": "BIGINT", "w_m": "BIGINT", "h_m": "BIGINT",
    "subtype": "STRING", "class": "STRING", "subclass": "STRING", "name_primary": "STRING",
    "category": "STRING", "confidence": "DOUBLE", "population": "BIGINT", "height": "DOUBLE",
    "min_height": "DOUBLE", "depth": "INT", "is_intermittent": "BOOLEAN", "has_parts": "BOOLEAN",
    "draw_from": "INT", "number": "STRING", "unit": "STRING", "street": "STRING",
    "version": "INT",
}


def pick(number: str, *values) -> str:
    """``values`` by the value of ``number``; beyond them, and for None, null."""
    def literal(value):
        if isinstance(value, bool):
            return str(value).lower()
        return f"'{value}'" if isinstance(value, str) else str(value)

    cases = [f"WHEN {n} THEN {literal(v)}" for n, v in enumerate(values) if v is not None]
    return f"CASE {number} {' '.join(cases)} END"


_PLACES = {
    "key": "p_partkey",
    "theme": "'places'", "type": "'place'", "id": "'place.' || CAST(p_partkey AS STRING)",
    "geom_type": "'Point'",
    "lon_m": "(p_partkey * 7919) % 360000", "lat_m": "(p_partkey * 104729) % 170000",
    "name_primary": "p_name",
    "category": pick(
        "p_partkey % 19", "airport", "pub", "thai_restaurant", "coffee_shop", "hotel",
        "gas_station", "park", "grocery_store", "hospital", "golf_course", "convenience_store",
        "parking", "train_station", "college_university", "stadium_arena", "museum",
        "barber_shop", "wine_bar"),
    "confidence": "(p_partkey % 100) / CAST(100 AS DOUBLE)",
}

_ADDRESSES = {
    "key": "c_custkey",
    "theme": "'addresses'", "type": "'address'", "id": "'address.' || CAST(c_custkey AS STRING)",
    "geom_type": "'Point'",
    "lon_m": "(c_custkey * 6101) % 360000", "lat_m": "(c_custkey * 93911) % 170000",
    "number": "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(c_custkey % 200 AS STRING) END",
    "unit": "CASE WHEN c_custkey % 3 = 0 THEN 'Unit ' || CAST(c_custkey % 40 AS STRING) END",
    "street": "CASE WHEN c_custkey % 13 <> 0 THEN 'Street ' || CAST(c_nationkey AS STRING) END",
}

_TRANSPORTATION = {
    "key": "o_orderkey",
    "theme": "'transportation'",
    "type": "CASE WHEN o_orderkey % 8 = 7 THEN 'connector' ELSE 'segment' END",
    "id": "'way.' || CAST(o_orderkey AS STRING)",
    "geom_type": "CASE WHEN o_orderkey % 8 = 7 THEN 'Point' ELSE 'LineString' END",
    "lon_m": "(o_orderkey * 5003) % 360000", "lat_m": "(o_orderkey * 81799) % 170000",
    "w_m": "CASE WHEN o_orderkey % 8 = 7 THEN 0 ELSE o_orderkey % 300 END",
    "h_m": "CASE WHEN o_orderkey % 8 = 7 THEN 0 ELSE o_orderkey % 200 END",
    "subtype": "CASE WHEN o_orderkey % 8 <> 7 THEN CASE o_orderkey % 11 WHEN 8 THEN 'rail' "
               "WHEN 9 THEN 'water' WHEN 10 THEN NULL ELSE 'road' END END",
    "class": "CASE WHEN o_orderkey % 8 <> 7 THEN " + pick(
        "o_orderkey % 15", "motorway", "trunk", "primary", "secondary", "tertiary", "residential",
        "living_street", "footway", "steps", "service", "pedestrian", "unclassified", "cycleway",
        "track") + " END",
    "subclass": "CASE WHEN o_orderkey % 8 <> 7 AND o_orderkey % 15 = 7 AND o_orderkey % 2 = 0 "
                "THEN 'sidewalk' END",
    "name_primary": "CASE WHEN o_orderkey % 8 <> 7 THEN 'Road ' || CAST(o_orderkey % 500 AS STRING) END",
}

_BUILDINGS = {
    "key": "l_orderkey * 8 + l_linenumber",
    "theme": "'buildings'",
    "type": "CASE WHEN l_linenumber = 7 THEN 'building_part' ELSE 'building' END",
    "id": "'building.' || CAST(l_orderkey AS STRING) || '.' || CAST(l_linenumber AS STRING) || '.' "
          "|| CAST(l_partkey AS STRING) || '.' || CAST(l_suppkey AS STRING)",
    "geom_type": "CASE WHEN l_suppkey % 10 = 9 THEN 'Point' ELSE 'Polygon' END",
    "lon_m": "(l_orderkey * 7907 + l_linenumber) % 360000", "lat_m": "(l_partkey * 104723) % 170000",
    "w_m": "CASE WHEN l_suppkey % 10 = 9 THEN 0 ELSE 1 + l_partkey % 5 END",
    "h_m": "CASE WHEN l_suppkey % 10 = 9 THEN 0 ELSE 1 + l_partkey % 3 END",
    "subtype": "CASE WHEN l_linenumber < 7 AND l_returnflag = 'A' THEN 'residential' END",
    "height": "CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END",
    "min_height": "CASE WHEN l_linenumber % 6 = 0 THEN CAST(l_orderkey % 5 - 1 AS DOUBLE) END",
    "has_parts": "CASE WHEN l_linenumber < 7 THEN " + pick(
        "(l_orderkey + l_linenumber) % 5", True, None, False, False, False) + " END",
}

_DIVISIONS = {
    "key": "s_suppkey",
    "theme": "'divisions'",
    "type": pick("s_suppkey % 4", "division", "division", "division_area", "division_boundary"),
    "id": "'division.' || CAST(s_suppkey AS STRING)",
    "geom_type": pick("s_suppkey % 4", "Point", "Point", "Polygon", "LineString"),
    "lon_m": "(s_suppkey * 4001) % 360000", "lat_m": "(s_suppkey * 70001) % 170000",
    "w_m": "CASE WHEN s_suppkey % 4 < 2 THEN 0 ELSE (s_suppkey * 31) % 9000 END",
    "h_m": "CASE WHEN s_suppkey % 4 < 2 THEN 0 ELSE (s_suppkey * 17) % 7000 END",
    "subtype": pick(
        "s_suppkey % 13", "country", "dependency", "region", "macroregion", "county",
        "macrocounty", "locality", "localadmin", "borough", "neighborhood", "macrohood",
        "microhood"),
    "class": "CASE WHEN s_suppkey % 4 > 1 THEN " + pick("s_suppkey % 3", "maritime", "land") + " END",
    "name_primary": "CASE s_suppkey % 3 WHEN 0 THEN 'Sup ' || CAST(s_suppkey AS STRING) "
                    "WHEN 1 THEN s_name ELSE s_name || ' of the Northern Lands' END",
    "population": "CASE WHEN s_suppkey % 4 < 2 THEN s_suppkey * 30011 END",
}

_WATER, _LAND, _LAND_USE, _LAND_COVER, _INFRASTRUCTURE = (f"event_id % 6 = {n}" for n in range(5))

_BASE = {
    "key": "event_id",
    "theme": "'base'",
    "type": pick("event_id % 6", "water", "land", "land_use", "land_cover", "infrastructure", "bathymetry"),
    "id": "'base.' || CAST(event_id AS STRING)",
    "geom_type": pick("event_id % 7", "Point", "LineString", "LineString", *["Polygon"] * 4),
    "lon_m": "(event_id * 3001) % 360000", "lat_m": "(event_id * 60013) % 170000",
    "w_m": "CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id % 5000 END",
    "h_m": "CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id % 3000 END",
    "subtype": f"CASE WHEN {_WATER} THEN " + pick("event_id % 5", "ocean", "river", "lake", None, "stream")
               + f" WHEN {_LAND} THEN " + pick("event_id % 5", "land", "glacier", "forest", None, "rock")
               + f" WHEN {_LAND_USE} THEN " + pick("event_id % 5", "residential", "park", "medical", None, "military")
               + f" WHEN {_LAND_COVER} THEN " + pick(
                   "event_id % 11", "forest", "barren", "shrub", "grass", "crop", "wetland",
                   "mangrove", "moss", "snow", "urban")
               + f" WHEN {_INFRASTRUCTURE} THEN " + pick("event_id % 5", "airport", "pier", "tower", None, "airport")
               + " END",
    "class": f"CASE WHEN {_LAND} THEN " + pick("event_id % 11", "land", "land", "land", "cliff", "island")
             + f" WHEN {_LAND_USE} THEN " + pick(
                 "event_id % 13", "park", "golf_course", "garden", "pitch", "college", "university",
                 "hospital", "military", "base", "cemetery", "grave_yard", "farmland")
             + f" WHEN {_INFRASTRUCTURE} THEN " + pick("event_id % 11", "runway", "taxiway", "terminal")
             + " END",
    "name_primary": "CASE WHEN event_id % 6 < 3 AND event_id % 4 = 0 THEN 'Place ' || CAST(event_id % 900 AS STRING) END",
    "depth": "CASE WHEN event_id % 6 = 5 THEN " + pick(
        "event_id % 11", 3000, 2500, 2000, 1500, 1000, 500, 100, 0, 50, 90, 5000) + " END",
    "is_intermittent": f"CASE WHEN {_WATER} THEN " + pick("event_id % 11", True, False, False) + " END",
    "draw_from": f"CASE WHEN {_LAND_COVER} THEN CAST(event_id % 8 AS INT) END",
}

# Table that feeds each theme, and its columns.
FLAT = {
    "places": ("part", _PLACES),
    "addresses": ("customer", _ADDRESSES),
    "transportation": ("orders", _TRANSPORTATION),
    "buildings": ("lineitem", _BUILDINGS),
    "divisions": ("supplier", _DIVISIONS),
    "base": ("events", _BASE),
}


def _expressions(columns: dict[str, str]) -> list[str]:
    defaults = {"w_m": "0", "h_m": "0", "version": f"({columns['key']}) % 4"}
    return [
        f"CAST({columns.get(name, defaults.get(name, 'NULL'))} AS {type_}) AS {name}"
        for name, type_ in COLUMNS.items()
    ]


# -- SQL side ----------------------------------------------------------------

def _flat_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {', '.join(_expressions(columns))} FROM {table}" for table, columns in FLAT.values())


_RECORD_SQL = (
    "CASE key % 5 WHEN 0 THEN 'w' || key || '@1' WHEN 1 THEN 'n' || key "
    "WHEN 2 THEN 'R' || key || '@12' WHEN 3 THEN 'x' || key END"
)

PRELUDE = f"""
flat AS ({_flat_sql()}),
features AS MATERIALIZED (
  SELECT *, row_number() OVER () AS rid,
    CAST(lon_m AS DOUBLE) / 1000 - 180 AS xmin, CAST(lon_m + w_m AS DOUBLE) / 1000 - 180 AS xmax,
    CAST(lat_m AS DOUBLE) / 1000 - 85 AS ymin, CAST(lat_m + h_m AS DOUBLE) / 1000 - 85 AS ymax,
    CASE WHEN key % 7 <> 0 THEN name_primary END AS label,
    {_RECORD_SQL} AS root_record,
    CASE WHEN name_primary IS NOT NULL THEN
      '{{"primary":"' || name_primary || '","common":{{"'
      || CASE WHEN key % 2 = 0 THEN 'en":"' || name_primary || ' X"' ELSE 'fr":"' || name_primary || ' Y"' END
      || '}}' || CASE WHEN key % 7 = 0 THEN ',"rules":[{{"between":[0.0,0.5]}}]' ELSE '' END || '}}'
    END AS names_json
  FROM flat
),
sources AS (
  SELECT rid, id, type, theme, key, 0 AS slot, '' AS property, 'OpenStreetMap' AS dataset, root_record AS record_id
  FROM features WHERE key % 10 <> 3
  UNION ALL
  SELECT rid, id, type, theme, key, 1, 'properties/height', 'meta', 'm' || key FROM features WHERE key % 4 = 0
  UNION ALL
  SELECT rid, id, type, theme, key, 2, 'properties/geometry', 'Esri', 'e' || key FROM features WHERE key % 9 = 0
)"""


def sql(body: str, *ctes: str) -> str:
    """A statement over the feature views; ``ctes`` come before ``body``."""
    return "WITH " + ",\n".join([PRELUDE.strip(), *ctes]) + "\n" + body.strip()


def values_sql(name: str, columns: list[str], rows: list[tuple]) -> str:
    """A named table of literals."""
    def literal(value):
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).upper()
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

    listed = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {listed})"


def rules_sql(*modes: str) -> str:
    """The rule table as literals."""
    rows = [
        (mode, r.draw_order, r.rule_id, r.theme, r.type, r.kind, r.item, r.minzoom, r.maxzoom,
         r.selectable, r.icon, r.confidence)
        for mode in modes for r in RULES[mode]
    ]
    return values_sql(
        "rules",
        ["mode", "draw_order", "rule_id", "rule_theme", "rule_type", "kind", "item", "minzoom",
         "maxzoom", "selectable", "icon", "confidence_rule"],
        rows)


# -- Spark side --------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_frames: dict[tuple, DataFrame] = {}


def box(west, south, east, north):
    """A box struct out of four columns."""
    return F.struct(
        west.alias("xmin"), east.alias("xmax"), south.alias("ymin"), north.alias("ymax"))


def _nested(df: DataFrame) -> DataFrame:
    key, name = F.col("key"), F.col("name_primary")
    degrees = {c: F.col(c).cast("double") / 1000 for c in ("lon_m", "lat_m")}
    far = {"lon_m": (F.col("lon_m") + F.col("w_m")).cast("double") / 1000,
           "lat_m": (F.col("lat_m") + F.col("h_m")).cast("double") / 1000}
    common = F.when(key % 2 == 0, F.create_map(F.lit("en"), F.concat(name, F.lit(" X")))).otherwise(
        F.create_map(F.lit("fr"), F.concat(name, F.lit(" Y"))))
    rules = F.when(key % 7 == 0, F.array(F.struct(F.array(F.lit(0.0), F.lit(0.5)).alias("between"))))
    digits = key.cast("string")
    record = (
        F.when(key % 5 == 0, F.concat(F.lit("w"), digits, F.lit("@1")))
        .when(key % 5 == 1, F.concat(F.lit("n"), digits))
        .when(key % 5 == 2, F.concat(F.lit("R"), digits, F.lit("@12")))
        .when(key % 5 == 3, F.concat(F.lit("x"), digits))
    )

    def source(when, property_, dataset, record_id):
        return F.when(when, F.struct(
            F.lit(property_).alias("property"), F.lit(dataset).alias("dataset"),
            record_id.alias("record_id")))

    sources = F.filter(
        F.array(
            source(key % 10 != 3, "", "OpenStreetMap", record),
            source(key % 4 == 0, "properties/height", "meta", F.concat(F.lit("m"), digits)),
            source(key % 9 == 0, "properties/geometry", "Esri", F.concat(F.lit("e"), digits)),
        ),
        lambda entry: entry.isNotNull())
    return df.withColumns({
        "bbox": box(degrees["lon_m"] - 180, degrees["lat_m"] - 85, far["lon_m"] - 180, far["lat_m"] - 85),
        "names": F.when(name.isNotNull(), F.struct(
            name.alias("primary"), common.alias("common"), rules.alias("rules"))),
        "categories": F.when(F.col("category").isNotNull(), F.struct(
            F.col("category").alias("primary"), F.array(F.lit("other")).alias("alternate"))),
        "cartography": F.when(F.col("draw_from").isNotNull(), F.struct(
            F.col("draw_from").alias("min_zoom"), (F.col("draw_from") + 5).alias("max_zoom"))),
        "sources": sources,
    }).drop("lon_m", "lat_m", "w_m", "h_m", "name_primary", "category", "draw_from")


def features(spark: SparkSession, sf_dir: str, *themes: str) -> DataFrame:
    """Features of the given themes, or of all; ``key`` is the number they are made from."""
    known = (spark.sparkContext.applicationId, sf_dir, themes)
    if known not in _frames:
        frames = [
            table(spark, sf_dir, name).selectExpr(*_expressions(columns))
            for theme, (name, columns) in FLAT.items() if not themes or theme in themes
        ]
        result = frames[0]
        for more in frames[1:]:
            result = result.unionByName(more)
        _frames[known] = _nested(result)
    return _frames[known]


# -- views and choices -------------------------------------------------------

VIEW_SQL = """views AS (
  SELECT c_custkey AS view_id,
    CAST((c_custkey * 6007) % 360000 AS DOUBLE) / 1000 - 180 AS w,
    CAST((c_custkey * 90001) % 170000 AS DOUBLE) / 1000 - 85 AS s,
    CAST((c_custkey * 6007) % 360000 + 500 + (c_custkey * 37) % 9500 AS DOUBLE) / 1000 - 180 AS e,
    CAST((c_custkey * 90001) % 170000 + 500 + (c_custkey * 53) % 9500 AS DOUBLE) / 1000 - 85 AS n
  FROM customer)"""


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of half a degree to ten degrees for each customer."""
    sides = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS view_id",
        "CAST((c_custkey * 6007) % 360000 AS DOUBLE) / 1000 - 180 AS w",
        "CAST((c_custkey * 90001) % 170000 AS DOUBLE) / 1000 - 85 AS s",
        "CAST((c_custkey * 6007) % 360000 + 500 + (c_custkey * 37) % 9500 AS DOUBLE) / 1000 - 180 AS e",
        "CAST((c_custkey * 90001) % 170000 + 500 + (c_custkey * 53) % 9500 AS DOUBLE) / 1000 - 85 AS n",
    )
    return sides.select("view_id", box(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("box"))


ITEMS = sorted({r.item for rules in RULES.values() for r in rules if r.item})

VIEW_ITEM_SQL = (
    values_sql("items", ["item_no", "item"], list(enumerate(ITEMS)))
    + f""",
view_items AS (
  SELECT DISTINCT o_custkey AS view_id, item FROM orders
  JOIN items ON item_no = (o_orderkey * 7) % {len(ITEMS)})"""
)


def view_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items each customer has chosen: one per order."""
    items = F.broadcast(spark.createDataFrame(list(enumerate(ITEMS)), "item_no bigint, item string"))
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_custkey").alias("view_id"), ((F.col("o_orderkey") * 7) % len(ITEMS)).alias("item_no"))
        .join(items, "item_no").select("view_id", "item")
    )
