"""Box predicates, the box join and the release files around them."""

import math
import os
import random
import struct
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mapsheaf.functions.text import fixed3, number_text
from mapsheaf.functions.wkb import wkb_to_geojson
from mapsheaf.model import Box
from mapsheaf.operators import filters, joins
from mapsheaf.operators.views import selectable_hits, view_choices, view_extract, visible_types
from mapsheaf.queries.fixture import box
from mapsheaf.sources import catalog, export, release
from mapsheaf.sources.tiles import tile_table

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"


def boxed(spark, rows, name="bbox", key="id"):
    return spark.createDataFrame([(k, (float(w), float(e), float(s), float(n))) for k, w, s, e, n in rows], f"{key} string, {name} {BOX}")


def test_clip_is_closed_and_overlap_is_open(spark):
    rows = boxed(spark, [("touch", 10, 0, 11, 1), ("inside", 5, 5, 6, 6), ("outside", 12, 0, 13, 1)])
    region = (0, 0, 10, 10)
    assert {r.id for r in filters.bbox_clip(rows, region).collect()} == {"touch", "inside"}
    assert {r.id for r in filters.bbox_overlap(rows, region).collect()} == {"inside"}


@pytest.mark.parametrize("bad", [(1, 2, 3), (1, 2, 3, math.inf), (1, 2, 3, math.nan), "1,2,3,x", (1, 2, 3, None), None])
def test_boxes_need_four_finite_numbers(bad):
    with pytest.raises(ValueError):
        Box.of(bad)


def brute(features, boxes, closed):
    found = []
    for f, fw, fs, fe, fn in features:
        for b, bw, bs, be, bn in boxes:
            if closed and fw <= be and fe >= bw and fs <= bn and fn >= bs:
                found.append((f, b))
            if not closed and fw < be and fe > bw and fs < bn and fn > bs:
                found.append((f, b))
    return sorted(found)


def random_box(rng, n, sizes):
    w, s = rng.choice([rng.uniform(-180, 180), float(rng.randint(-180, 180))]), rng.uniform(-95, 90)
    size = rng.choice(sizes)
    return (str(n), w, s, w + size * rng.random(), s + size * rng.random())


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("hint", [None, "merge"])
def test_box_join_equals_all_pairs(spark, closed, hint):
    rng = random.Random(7)
    features = [random_box(rng, n, (0, 0.1, 1, 2, 30, 200)) for n in range(250)]
    # A third of the features in one place.
    features += [(f"hot{n}", 10.25, 10.25, 10.25, 10.25) for n in range(120)]
    boxes = [random_box(rng, n, (0.5, 1, 10, 90, 360)) for n in range(60)]
    boxes += [("hot", 10.25, 10.25, 11, 11), ("world", -180, -90, 180, 90)]
    pairs = joins.box_join(
        boxed(spark, features), boxed(spark, boxes, "box", "view_id"), closed=closed, hint=hint)
    assert sorted((r.id, r.view_id) for r in pairs.collect()) == brute(features, boxes, closed)


def test_boxes_across_180_degrees_count_as_two_parts(spark):
    features = [("east", 175, 1, 176, 2), ("west", -176, 1, -175, 2), ("far", 0, 1, 1, 2), ("across", 179, 1, -179, 2),
                ("wide", -180, 0, 180, 5), ("upside", 175, 2, 176, 1)]
    boxes = [("across", 174, 0, -174, 3), ("east", 170, 0, 180, 3), ("world", -180, -90, 180, 90)]
    frame = boxed(spark, features).union(spark.createDataFrame([("null", None)], f"id string, bbox {BOX}"))
    pairs = joins.box_join(frame, boxed(spark, boxes, "box", "view_id"))
    assert sorted((r.view_id, r.id) for r in pairs.collect()) == [
        ("across", "across"), ("across", "east"), ("across", "west"), ("across", "wide"),
        ("east", "across"), ("east", "east"), ("east", "wide"),
        ("world", "across"), ("world", "east"), ("world", "far"), ("world", "west"), ("world", "wide")]


def test_few_candidates_and_few_rows_for_each_box(spark):
    rng = random.Random(11)
    features = [random_box(rng, n, (0, 0.001, 0.05)) for n in range(3000)]
    clicks = boxed(spark, [(f"c{n}", 10 + n / 1e6, 10, 10.01 + n / 1e6, 10.01) for n in range(500)], "box", "click_id")
    world = boxed(spark, [("world", -180, -90, 180, 90)], "box", "click_id")
    for boxes in (clicks, world):
        rows = joins._explode_cells(joins._with_parts(boxes, "box", "b").withColumn(
            "_level", F.explode(F.sequence(F.col("_b_level"), F.lit(joins.LEVELS - 1)))), "b")
        assert max(r["count"] for r in rows.groupBy("click_id").count().collect()) <= 80
    crowded = boxed(spark, [*features, *((f"h{n}", 10.005, 10.005, 10.006, 10.006) for n in range(200))])
    pairs = joins.box_join(crowded, clicks, hint="merge")
    assert pairs.count() == len(brute([*features, *((f"h{n}", 10.005, 10.005, 10.006, 10.006) for n in range(200))], [
        (f"c{n}", 10 + n / 1e6, 10, 10.01 + n / 1e6, 10.01) for n in range(500)], True))
    assert "GlobalLimit" not in pairs._jdf.queryExecution().toString()


def test_salted_join_splits_a_hot_key_and_keeps_all_rows(spark):
    left = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    joined = joins.salted_join(left, right, ["k"], "inner", F.col("id"), task_rows=100)
    assert joined.count() == 1000 and joined.columns == ["k", "id", "v"]
    semi = joins.salted_join(left, right.select("k"), ["k"], "left_semi", F.col("id"), task_rows=100)
    assert semi.count() == 1000


def test_numbered_counts_in_order_over_all_parts(spark):
    rows = spark.range(500).select(F.format_string("f%04d", (F.col("id") * 37) % 500).alias("name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        listed = joins.numbered(rows, ["name"], "no").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.no, r.name) for r in listed) == [(n, f"f{n:04d}") for n in range(500)]


def test_download_catalog_prunes_by_type_and_box(spark):
    manifest = spark.createDataFrame([
        ("building-0", 0, "building", "theme=buildings/type=building/part-0.parquet", (34.0, 35.0, 32.0, 33.0)),
        ("land-1", 1, "land", "theme=base/type=land/part-0.parquet", (30.0, 31.0, 30.0, 31.0)),
    ], f"file_id string, file_no int, type string, rel_path string, bbox {BOX}")
    requests = spark.createDataFrame(
        [("r", type_, (34.1, 34.9, 32.1, 32.9)) for type_ in ("building", "land", "place")]
        + [("touch", "building", (35.0, 36.0, 32.0, 33.0))],
        f"request_id string, type string, box {BOX}")
    found = catalog.download_catalog(manifest, requests).collect()
    assert [(r.request_id, r.type, r.rel_path) for r in found] == [
        ("r", "building", "theme=buildings/type=building/part-0.parquet")]


@pytest.fixture(scope="module")
def release_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("release"))
    water = spark.createDataFrame(
        [("w1", (0.0, 1.0, 0.0, 1.0), "lake"), ("w2", (50.0, 51.0, 0.0, 1.0), "ocean")],
        f"id string, bbox {BOX}, subtype string")
    land = spark.createDataFrame(
        [("l1", (90.0, 91.0, 0.0, 1.0), "cliff")], f"id string, bbox {BOX}, class string")
    use = spark.createDataFrame([("u1", (1.0, 2.0, 0.0, 1.0), 3)], f"id string, bbox {BOX}, version int")
    water.repartition(2, "id").write.parquet(f"{root}/theme=base/type=water")
    land.write.parquet(f"{root}/theme=base/type=land")
    use.write.parquet(f"{root}/theme=base/type=land_use")
    return root


def test_scan_unifies_columns_and_takes_types_from_the_path(spark, release_dir):
    rows = {r.id: r for r in release.scan_release(spark, release_dir).collect()}
    assert (rows["w1"].type, rows["w1"].subtype, rows["w1"]["class"]) == ("water", "lake", None)
    assert rows["l1"].theme == "base" and "type=land/" in rows["l1"].filename
    assert release.scan_release(spark, release_dir, "base", "water").count() == 2
    known = release.scan_release(spark, release_dir, "base", "land", schema=f"id string, bbox {BOX}")
    assert [r.id for r in known.collect()] == ["l1"]
    with pytest.raises(ValueError):
        release.scan_release(spark, release_dir, "places", "water")


def test_scan_pushes_the_box_and_prunes_columns(spark, release_dir, capsys):
    filters.bbox_clip(release.scan_release(spark, release_dir, "base"), (0, 0, 2, 2)).select("id").explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(bbox.xmin,2.0)" in plan and "subtype" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_clip_writes_only_types_with_rows(spark, release_dir, tmp_path):
    out = str(tmp_path)
    release.clip_release(spark, release_dir, out, "base", "0,0,2,2", cluster=True)
    assert {d for d in os.listdir(f"{out}/theme=base") if d.startswith("type=")} == {"type=water", "type=land_use"}
    clipped = release.scan_release(spark, out)
    assert sorted((r.id, r.type) for r in clipped.collect()) == [("u1", "land_use"), ("w1", "water")]
    release.clip_release(spark, release_dir, out, "base")
    assert release.scan_release(spark, out).count() == 4
    with pytest.raises(ValueError):
        release.clip_release(spark, release_dir, out, "weather")


def test_manifest_numbers_files_over_all_types(spark, release_dir):
    rows = catalog.file_manifest(release.scan_release(spark, release_dir), release_dir).orderBy("file_no").collect()
    assert [r.file_no for r in rows] == list(range(len(rows)))
    assert [r.rel_path for r in rows] == sorted(r.rel_path for r in rows)
    assert all(r.file_id == f"{r.type}-{r.file_no}" and os.path.exists(r.path) for r in rows)
    assert sum(r.features for r in rows) == 4
    land = next(r for r in rows if r.type == "land")
    assert tuple(land.bbox) == (90.0, 91.0, 0.0, 1.0)


def test_catalog_flags_the_newest_and_skips_seen_releases(spark):
    tiles = spark.createDataFrame(
        [("2024-08", "base"), ("2024-09", "base"), ("2024-09", "places"), ("2024-09", "weather"), ("2024-10", "base")],
        "release string, theme string")
    releases = spark.createDataFrame([("2024-08",), ("2024-09",)], "release string")
    rows = catalog.release_catalog(tiles, releases)
    assert sorted((r.release, r.theme, r.latest) for r in rows.collect()) == [
        ("2024-08", "base", False), ("2024-09", "base", True), ("2024-09", "places", True)]
    new = catalog.latest_release(rows, releases.where("release = '2024-08'"))
    assert {r.path for r in new.collect()} == {"2024-09/base", "2024-09/places"}
    assert catalog.latest_release(rows, releases).count() == 0


def test_export_summary(spark):
    frame = spark.createDataFrame(
        [("place", (-77.6860, -77.6860, 39.14, 39.14)), ("building", (-77.69, -77.685, 39.14, 39.141)),
         ("place", (-77.6860, -77.6860, 39.14, 39.14)), ("land", (0.0, 1.0, 0.0, 1.0))], f"type string, bbox {BOX}")
    now = datetime(2026, 1, 15, 12, 34, 56)
    row = export.export_summary(frame, (-77.6904949, 39.1365536, -77.68, 39.15), "2024-09-18", now).first()
    assert row.bbox_text == "-77.6904949,39.1365536,-77.68,39.15"
    assert (row.west, row.north) == (-77.6904949, 39.15)
    assert (row.release, row.layers, row.layer_count, row.features) == ("2024-09-18", "building,place", 2, 3)
    assert row.generated_at == now
    empty = export.export_summary(frame, (100, 50, 101, 51), "r").first()
    assert (empty.layers, empty.features) == ("", 0)
    with pytest.raises(ValueError):
        export.export_summary(frame, (1, 2, 3, 4), "")
    with pytest.raises(ValueError):
        export.export_summary(frame, (1, 2, 3, float("nan")), "r")


def test_summaries_leave_out_boxes_that_are_not_finite(spark):
    pairs = spark.createDataFrame(
        [("a", "place", (0.0, 1.0, 0.0, 1.0)), ("b", "place", (0.0, float("inf"), 0.0, 1.0))],
        f"view_id string, type string, box {BOX}")
    assert [r.view_id for r in export.export_summaries(pairs, "r").collect()] == ["a"]


def test_number_texts(spark):
    numbers = [34.0, -77.6904949, 0.0005, 12345678.5, 0.0625, -0.0625, 34.1705, 179.9996, 1.0005, -0.0001]
    rows = spark.createDataFrame([(n,) for n in numbers], "n double").select(
        number_text(F.col("n")).alias("plain"), fixed3(F.col("n")).alias("fixed")).collect()
    assert [r.plain for r in rows] == [
        "34", "-77.6904949", "0.0005", "12345678.5", "0.0625", "-0.0625", "34.1705", "179.9996",
        "1.0005", "-0.0001"]
    assert [r.fixed for r in rows] == [
        "34.000", "-77.690", "0.001", "12345678.500", "0.063", "-0.063", "34.170", "180.000", "1.000", "-0.000"]


def test_geojson_by_type(spark, tmp_path):
    import json
    import struct
    point = struct.pack("<BIdd", 1, 1, 2.5, 3.0)
    ring = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 4) + struct.pack("<8d", 0, 0, 1, 0, 1, 1, 0, 0)
    many = struct.pack(">BII", 0, 4, 2) + struct.pack(">BIdd", 0, 1, 1, 2) + struct.pack(">BIdd", 0, 1, 3, 4)
    frame = spark.createDataFrame(
        [("place", "p", (2.5, 2.5, 3.0, 3.0), bytearray(point)), ("water", "w", (0.0, 1.0, 0.0, 1.0), bytearray(ring)),
         ("place", "m", (1.0, 3.0, 2.0, 4.0), bytearray(many)), ("land", "l", (0.0, 1.0, 0.0, 1.0), None),
         ("segment", "far", (90.0, 91.0, 0.0, 1.0), None)],
        f"type string, id string, bbox {BOX}, geometry binary")
    out = str(tmp_path / "geojson")
    export.export_geojson(frame, (0, 0, 5, 5), ["place", "water", "segment"], out)
    assert {d for d in os.listdir(out) if d.startswith("type=")} == {"type=place", "type=water"}
    found = {}
    for r in spark.read.text(out).collect():
        feature = json.loads(r.value)
        found[feature["properties"]["id"]] = feature["geometry"]
    assert found["p"] == {"type": "Point", "coordinates": [2.5, 3]}
    assert found["w"] == {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    assert found["m"] == {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}


def test_tile_table_replaces_its_theme_only(spark, tmp_path):
    out = str(tmp_path / "tiles")
    rows = spark.createDataFrame(
        [("base", "a", 1, 0, 0), ("base", "b", 2, 0, 1), ("places", "c", 2, 1, 1)],
        "theme string, id string, z int, x int, y int")
    for theme in ("base", "places"):
        tile_table(rows, out, theme)
    tile_table(rows.where("z = 1"), out, "base")
    left = spark.read.option("basePath", out).parquet(f"{out}/theme=*")
    assert sorted((r.theme, r.id, r.z) for r in left.collect()) == [("base", "a", 1), ("places", "c", 2)]


def test_visible_types_and_extract(spark):
    items = spark.createDataFrame(
        [("v", "road-trunk"), ("v", "road-trunk"), ("v", "place-label"), ("w", "unknown")], "view_id string, item string")
    assert {(r.view_id, r.type) for r in visible_types(items).collect()} == {("v", "segment"), ("v", "place")}
    views = spark.createDataFrame([("v", (0.0, 2.0, 0.0, 2.0)), ("w", (0.0, 2.0, 0.0, 2.0))], f"view_id string, box {BOX}")
    rows = spark.createDataFrame(
        [("s", "segment", (2.0, 3.0, 2.0, 3.0)), ("l", "land", (1.0, 1.5, 1.0, 1.5))], f"id string, type string, bbox {BOX}")
    found = view_extract(rows, views, view_choices(items)).collect()
    assert [(r.view_id, r.id) for r in found] == [("v", "s")]


def test_selectable_hits(spark):
    hits = spark.createDataFrame([
        ("v", "a", 1, "road-trunk", "segment", True), ("v", "b", 2, "road-trunk", "segment", False),
        ("v", "c", 3, None, "segment", None), ("v", "d", 4, None, "place", True),
        ("w", "e", 5, None, None, True), ("w", "f", 6, "road-trunk", "segment", True),
    ], "view_id string, id string, draw_order int, item string, rule_type string, selectable boolean")
    items = spark.createDataFrame([("v", "road-trunk"), ("w", "land")], "view_id string, item string")
    assert {r.id for r in selectable_hits(hits, items).collect()} == {"a", "c"}


def test_bbox_label(spark):
    rows = spark.createDataFrame([(34.17, 29.45, 35.91, 33.38)], "w double, s double, e double, n double").select(
        F.lit("place").alias("type"), box(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("box"))
    row = export.bbox_label(rows, "2026-02-18.0", "extract").first()
    assert row.label == "34.170,29.450,35.910,33.380"
    assert row.file_name == "extract-2026-02-18.0-place-34.170,29.450,35.910,33.380.geojson"
    assert row.archive_name == "extract-2026-02-18.0-34.170,29.450,35.910,33.380.zip"


def test_geometry_that_is_empty_or_damaged(spark):
    point = struct.pack("<BIdd", 1, 1, 1.5, 2.0)
    rows = [(0, point), (1, struct.pack("<BIdd", 1, 1, math.nan, math.nan)), (2, point[:9]), (3, b""), (4, b"\x01\x63\x00\x00\x00"),
            (5, None), (6, struct.pack("<BII4d", 1, 2, 2, 0, 1, 2.25, 3)), (7, struct.pack("<BII", 1, 2, 4_000_000_000))]
    frame = spark.createDataFrame(rows, "n int, g binary").select("n", wkb_to_geojson("g").alias("text"))
    assert {r.n: r.text for r in frame.collect()} == {
        0: '{"type":"Point","coordinates":[1.5,2]}', 1: '{"type":"Point","coordinates":[]}', 2: None, 3: None, 4: None,
        5: None, 6: '{"type":"LineString","coordinates":[[0,1],[2.25,3]]}', 7: None}


def test_boxes_are_not_broadcast_by_their_size_before_they_have_cells(spark):
    box = F.struct((F.col("id") / 10).alias("xmin"), (F.col("id") / 10 + 1).alias("xmax"),
                   F.lit(1.0).alias("ymin"), F.lit(2.0).alias("ymax"))
    frame = spark.range(100)
    pairs = joins.box_join(frame.select("id", box.alias("bbox")), frame.select(F.col("id").alias("view_id"), box.alias("box")))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert pairs.count() == sum(abs(a - b) <= 10 for a in range(100) for b in range(100))
