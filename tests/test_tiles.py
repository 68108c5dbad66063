"""Profiles, tags and tiles."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mapsheaf.operators import tags, tiling
from mapsheaf.plans import profiles

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"


def zooms(spark, theme, rows, extra=""):
    frame = spark.createDataFrame(
        rows, "id string, type string, geom_type string, subtype string, class string" + extra)
    profiled = profiles.theme_profile(
        frame.withColumn("theme", F.lit(theme)), theme,
        {**profiles.PROFILES, "buildings": profiles.zoom_buildings})
    return {r.id: (r.min_zoom, r.max_zoom, r.tags_zoom, r.min_pixel) for r in profiled.collect()}


def test_base_zooms(spark):
    rows = [
        ("pylon", "infrastructure", "Point", None, None, None),
        ("peak", "land", "Point", "land", None, None), ("coast", "land", "Polygon", "land", None, None),
        ("ice", "land", "LineString", "glacier", None, None), ("wood", "land", "Polygon", None, None, None),
        ("deep", "bathymetry", "Polygon", None, None, None),
        ("home", "land_use", "Polygon", "residential", None, None), ("spot", "land_use", "Point", "residential", None, None),
        ("farm", "land_use", "Polygon", None, None, None),
        ("cover", "land_cover", "Polygon", "snow", None, (3, 20)), ("plain", "land_cover", "Polygon", "snow", None, (8, 9)),
        ("sea", "water", "Point", "ocean", None, None), ("spring", "water", "Point", "spring", None, None),
        ("main", "water", "LineString", "ocean", None, None), ("lake", "water", "Polygon", None, None, None),
        ("river", "water", "LineString", "river", None, None), ("ditch", "water", "LineString", None, None, None),
    ]
    assert zooms(spark, "base", rows, ", cartography struct<min_zoom:int,max_zoom:int>") == {
        "pylon": (13, 13, 13, None), "peak": (13, 13, 13, None), "coast": (0, 13, 13, 0), "ice": (0, 13, 13, 0),
        "wood": (7, 13, 13, None), "deep": (0, 13, 13, 0), "home": (6, 13, 13, None), "spot": (13, 13, 13, None),
        "farm": (9, 13, 13, None), "cover": (3, 13, 3, None), "plain": (8, 9, 8, None), "sea": (0, 13, 0, None),
        "spring": (8, 13, 8, None), "main": (0, 13, 0, 0), "lake": (4, 13, 4, 0), "river": (9, 13, 9, None),
        "ditch": (13, 13, 13, None),
    }


def test_other_zooms(spark):
    assert zooms(spark, "divisions", [
        ("a", "division", "Point", "country", None), ("b", "division_area", "Polygon", "region", None),
        ("c", "division_boundary", "LineString", "county", None), ("d", "division", "Point", None, None)]) == {
        "a": (0, 12, 0, None), "b": (4, 12, 4, 0), "c": (8, 12, 8, 0), "d": (10, 12, 10, None)}
    classes = {"motorway": 4, "trunk": 5, "primary": 7, "secondary": 9, "tertiary": 11, "residential": 12,
               "living_street": 13, "service": 14, None: 14}
    found = zooms(spark, "transportation", [
        *((f"road {c}", "segment", "LineString", "road", c) for c in classes),
        ("rail", "segment", "LineString", "rail", "motorway"), ("water", "segment", "LineString", "water", None),
        ("none", "segment", "LineString", None, None), ("joint", "connector", "Point", None, None)])
    assert found == {
        **{f"road {c}": (z, 14, 14, 0) for c, z in classes.items()},
        "rail": (8, 14, 14, 0), "water": (10, 14, 14, 0), "none": (10, 14, 14, 0), "joint": (13, 14, 14, None)}
    assert zooms(spark, "places", [("p", "place", "Point", None, None)]) == {"p": (14, 14, 14, None)}
    assert zooms(spark, "addresses", [("p", "address", "Point", None, None)]) == {"p": (14, 14, 14, None)}
    assert zooms(spark, "buildings", [("p", "building", "Polygon", None, None)]) == {"p": (None, 14, 14, None)}


def test_profiles_are_chosen_by_theme_and_can_be_replaced(spark):
    frame = spark.createDataFrame([("places", "a"), ("base", "b")], "theme string, id string")
    own = profiles.theme_profile(frame, "places", {"places": lambda df: df.withColumn("min_zoom", F.lit(3))})
    assert [(r.id, r.min_zoom) for r in own.collect()] == [("a", 3)]
    with pytest.raises(ValueError):
        profiles.theme_profile(frame, "weather")


def test_label_is_left_out_when_a_rule_covers_a_part(spark):
    names = "struct<primary:string,rules:array<struct<between:array<double>>>>"
    frame = spark.createDataFrame(
        [("a", ("A", None)), ("b", ("B", [(None,)])), ("c", ("C", [(None,), ([0.0, 0.5],)])), ("d", None)],
        f"id string, names {names}")
    assert {r.id: r["@name"] for r in tags.primary_label(frame).collect()} == {"a": "A", "b": "B", "c": None, "d": None}


def test_sources_of_height_and_geometry(spark):
    source = "array<struct<property:string,dataset:string>>"
    rows = [
        ("own", 5.0, [("", "root"), ("properties/height", "h1"), ("properties/height", "h2"), ("properties/geometry", "g")]),
        ("root", 5.0, [("other", "x"), ("", "root")]), ("no height", None, [("", "root")]), ("none", 5.0, []),
        ("unnamed", 5.0, [("", "root"), ("properties/height", None)]),
    ]
    frame = spark.createDataFrame(rows, f"id string, height double, sources {source}")
    found = {r.id: (r["@height_source"], r["@geometry_source"])
             for r in tags.geometry_source(tags.height_source(frame)).collect()}
    assert found == {"own": ("h1", "g"), "root": ("root", "root"), "no height": (None, "root"), "none": (None, None),
                     "unnamed": (None, "root")}


def test_tags_keep_primitives_and_write_nested_values_as_text(spark):
    frame = spark.createDataFrame(
        [("a", (0.0, 0.0, 0.0, 0.0), 3, True, None, ("A", None), [1, 2])],
        f"id string, bbox {BOX}, level int, flag boolean, class string, names struct<primary:string,x:int>, list array<int>")
    flat = tags.flatten_tags(frame)
    assert flat.columns == ["id", "level", "flag", "class", "names", "list", "@name"]
    row = flat.first()
    assert (row.level, row.flag, row.names, row.list, row["@name"]) == (3, True, '{"primary":"A"}', "[1,2]", "A")
    assert tags.tag_map(frame).first().tags == {
        "id": "a", "level": "3", "flag": "true", "names": '{"primary":"A"}', "list": "[1,2]", "@name": "A"}


def test_helper_columns_are_no_tags(spark):
    frame = spark.createDataFrame(
        [("a", "Point", 3, 9, 5, 1, "f.parquet", 7)],
        "id string, geom_type string, min_zoom int, max_zoom int, tags_zoom int, min_pixel int, filename string, level int")
    assert tags.tag_map(frame).first().tags == {"id": "a", "level": "7"}
    assert tags.flatten_tags(frame).columns == ["id", "level"]


def boxed(spark, rows, more=""):
    return spark.createDataFrame(rows, f"id string, bbox {BOX}" + more)


def test_tags_show_by_size_or_zoom(spark):
    # One degree is 256 * 2**5 / 360 = 22.8 pixels at zoom 5, and 11.4 at zoom 4.
    frame = boxed(spark, [("a", (0.0, 1.0, 0.0, 0.0), 9, {"k": "v"})], ", tags_zoom int, tags map<string,string>")
    shown = [len(tags.attribute_visibility(frame, z).first().tags) for z in (4, 5, 8, 9)]
    assert shown == [0, 1, 1, 1]
    always = boxed(spark, [("a", (0.0, 0.0, 0.0, 0.0), 9, {"k": "v", "@height_source": "x"})], ", tags_zoom int, tags map<string,string>")
    assert tags.attribute_visibility(always, 3).first().tags == {"@height_source": "x"}
    point = boxed(spark, [("a", (0.0, 0.0, 0.0, 0.0), 9, {"k": "v"})], ", tags_zoom int, tags map<string,string>")
    assert [len(tags.attribute_visibility(point, z).first().tags) for z in (8, 9)] == [0, 1]


def test_small_features_are_dropped_unless_any_size_will_do(spark):
    rows = [("line", (0.0, 0.01, 0.0, 0.0), "LineString", None), ("any", (0.0, 0.0001, 0.0, 0.0), "LineString", 0),
            ("point", (0.0, 0.0, 0.0, 0.0), "Point", None)]
    frame = boxed(spark, rows, ", geom_type string, min_pixel int")
    assert {r.id for r in tags.min_pixel_filter(frame, 5).collect()} == {"any", "point"}
    assert {r.id for r in tags.min_pixel_filter(frame, 8).collect()} == {"line", "any", "point"}


def tiles_of(box, low, high):
    """All tiles of a box by the textbook formula."""
    west, east, south, north = box

    def index(lon, lat, z):
        lat = max(-85.0511287, min(85.0511287, lat))
        n = 2**z
        x = math.floor((lon + 180) / 360 * n)
        y = math.floor((1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n)
        return max(0, min(n - 1, x)), max(0, min(n - 1, y))

    found = []
    for z in range(low, high + 1):
        (x0, y0), (x1, y1) = index(west, north, z), index(east, south, z)
        found += [(z, x, y) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)]
    return found


@pytest.mark.parametrize("spread", [4, 4096])
def test_tiles_of_narrow_and_wide_features(spark, spread):
    rows = [
        ("point", (34.17, 34.17, 29.45, 29.45), 3, 8), ("country", (-10.3, 35.9, 29.4, 60.1), 0, 7),
        ("world", (-180.0, 180.0, -90.0, 90.0), 0, 5), ("edge", (179.9, 184.0, 84.0, 89.0), 0, 6),
        ("late", (0.1, 0.2, 0.1, 0.2), 9, 14), ("open", (0.1, 0.2, 0.1, 0.2), None, None),
    ]
    frame = boxed(spark, rows, ", min_zoom int, max_zoom int")
    found = Counter((r.id, r.z, r.x, r.y) for r in tiling.tile_assign(frame, 0, 8, spread).collect())
    expected = Counter(
        (id_, *tile) for id_, box, low, high in rows
        for tile in tiles_of(box, low or 0, 8 if high is None else min(high, 8)))
    assert found == expected and "late" not in {key[0] for key in found}


def test_a_box_across_180_degrees_is_two(spark):
    frame = boxed(spark, [("fiji", (170.0, -170.0, 1.0, 1.0)), ("wide", (10.0, 9.0, 1.0, 1.0))])
    found = Counter((r.id, r.z, r.x) for r in tiling.tile_assign(frame, 0, 4).collect())
    assert set(found.values()) == {1}
    assert {k[2] for k in found if k[:2] == ("fiji", 4)} == {0, 15}
    assert {k[2] for k in found if k[:2] == ("wide", 4)} == set(range(16))
    place = spark.createDataFrame(
        [("place", "Point", (179.75, -179.25, 1.0, 1.0)), ("place", "Point", (179.25, -179.75, 1.0, 1.0))],
        f"type string, geom_type string, bbox {BOX}")
    assert sorted(r.x for r in tiling.place_density(place, 8).collect()) == [0, 255]


def test_a_wide_feature_is_shared_by_tasks(spark):
    frame = boxed(spark, [("world", (-180.0, 180.0, -90.0, 90.0))]).coalesce(1)
    tiles = tiling.tile_assign(frame, 0, 7, 64).withColumn("task", F.spark_partition_id())
    counts = [r["count"] for r in tiles.groupBy("task").count().collect()]
    assert sum(counts) == sum(4**z for z in range(8)) and len(counts) > 2


def test_density_counts_points_per_cell(spark):
    rows = [("a", (10.0, 10.0, 10.0, 10.0), "place", "Point"), ("b", (11.0, 11.0, 11.0, 11.0), "place", "Point"),
            ("c", (-10.0, -10.0, 10.0, 10.0), "place", "Point"), ("d", (10.0, 10.0, 10.0, 10.0), "water", "Point")]
    frame = boxed(spark, rows, ", type string, geom_type string")
    cells = {(r.x, r.y): (r.places, r.intensity, r.radius) for r in tiling.place_density(frame, 1).collect()}
    assert cells == {(1, 0): (2, 1 + 2 / 9, 2 + 4 / 9), (0, 0): (1, 1 + 2 / 9, 2 + 4 / 9)}
    both = tiling.place_density(frame, 0, 8).collect()
    assert sum(r.places for r in both if r.z == 0) == 3 and sorted(r.places for r in both if r.z == 8) == [1, 2]
    with pytest.raises(ValueError):
        tiling.place_density(frame, 9)


def test_layer_stats(spark):
    rows = [("a", (0.0, 1.0, 0.0, 1.0), "base", "water", 2, 3, 0, "lake", None, True),
            ("b", (5.0, 6.0, -3.0, 1.0), "base", "land", 4, 4, 0, None, None, None)]
    frame = boxed(spark, rows, ", theme string, type string, min_zoom int, max_zoom int, x int, subtype string, depth int, wet boolean")
    stats = {(r.layer, r.field): r for r in tiling.tile_layer_stats(frame).collect()}
    assert set(stats) == {("water", "id"), ("water", "subtype"), ("water", "wet"), ("land", "id")}
    row = stats["water", "wet"]
    assert (row.field_type, row.layer_minzoom, row.theme_minzoom, row.theme_maxzoom) == ("Boolean", 2, 2, 4)
    assert (row.west, row.south, row.east, row.north) == (0.0, -3.0, 6.0, 1.0)


def test_layer_kind(spark):
    frame = spark.createDataFrame([("Point",), ("Polygon",), ("MultiPolygon",), ("LineString",)], "geom_type string")
    kinds = tags.geometry_layer_kind(frame.withColumn("type", F.lit("water"))).collect()
    assert [(k.layer, k.layer_kind) for k in kinds] == [
        ("water", "point"), ("water", "polygon"), ("water", "polygon"), ("water", "line")]


def test_features_on_few_tiles_are_dealt_out_as_one_row(spark):
    box = F.struct((F.col("id") / 100).alias("xmin"), (F.col("id") / 100 + 0.001).alias("xmax"),
                   F.lit(1.0).alias("ymin"), F.lit(1.001).alias("ymax"))
    frame = spark.range(0, 1000, 1, 3).select(F.col("id").cast("string").alias("id"), box.alias("bbox"))
    wide = spark.range(1).select(F.lit("wide").alias("id"), F.struct(*(F.lit(v).alias(c) for c, v in (
        ("xmin", 0.0), ("xmax", 90.0), ("ymin", 0.0), ("ymax", 40.0)))).alias("bbox"))
    tiles = tiling.tile_assign(frame.union(wide), 5, 7).withColumn("part", F.spark_partition_id())
    parts = tiles.groupBy("id").agg(F.count_distinct("part").alias("parts"))
    assert max(r.parts for r in parts.where("id <> 'wide'").collect()) == 1
    assert parts.where("id = 'wide'").first().parts > 1


@pytest.mark.parametrize("depth", [0, 2, 5])
def test_tiles_by_place_are_the_same_and_none_is_shuffled(spark, depth, capsys):
    boxes = [("world", (-180.0, 180.0, -90.0, 90.0)), ("crosses", (179.0, -179.0, 10.0, 12.0)), ("half", (10.0, -10.0, -5.0, 5.0)),
             ("point", (10.0, 10.0, 10.0, 10.0)), ("wide", (-100.0, -97.0, 30.0, 40.0)), (None, (0.0, 0.1, 0.0, 0.1))]
    frame = boxed(spark, boxes).withColumn("min_zoom", F.when(F.col("id") == "wide", 3))
    wanted = Counter(tuple(r) for r in tiling.tile_assign(frame, 1, 8).select("id", "z", "x", "y").collect())
    found = tiling.tile_assign(frame, 1, 8, by_place=depth)
    assert found.columns == tiling.tile_assign(frame, 1, 8).columns
    assert Counter(tuple(r) for r in found.select("id", "z", "x", "y").collect()) == wanted
    found.explain()
    plan = capsys.readouterr().out.splitlines()
    # Tiles are the outermost rows: they come of exploding what was shuffled and sorted.
    tiles = next(n for n, line in enumerate(plan) if "Generate explode" in line and "[y#" in line)
    assert not any("Exchange" in line or "Sort" in line for line in plan[:tiles])
