"""Choices of views as bits: the same rows as by name, and no pair is shuffled for them."""

import random

from pyspark.sql import functions as F

from mapsheaf.operators import views as op
from mapsheaf.sources import catalog, release

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"
ITEM_NAMES = [*op._ITEMS, "unknown", None]
TYPE_NAMES = [*op._TYPES, "odd", None]


def view_boxes(spark, n):
    return spark.createDataFrame([(v, (0.0, 1.0 + v % 3, 0.0, 1.0)) for v in range(n)], f"view_id int, box {BOX}")


def test_types_of_views_by_bits(spark):
    rng = random.Random(5)
    chosen = [(v, rng.sample(TYPE_NAMES, rng.randrange(5))) for v in range(12)] + [(12, None), (3, ["odd", "land"])]
    choices = spark.createDataFrame(chosen, "view_id int, types array<string>")
    rows = spark.createDataFrame([(n, name, (n % 3 + 0.5, n % 3 + 0.5, 0.5, 0.5)) for n, name in enumerate(TYPE_NAMES * 3)],
                                 f"id int, type string, bbox {BOX}")
    found = op.view_extract(rows, view_boxes(spark, 13), choices)
    assert found.columns == ["id", "type", "bbox", "view_id", "box"]
    wanted = sorted((v, n) for n, name in enumerate(TYPE_NAMES * 3) for v, names in chosen
                    if name and name in (names or []) and n % 3 + 0.5 <= 1 + v % 3)
    assert sorted((r.view_id, r.id) for r in found.collect()) == wanted and wanted
    join = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in line)
    assert "_types" in join and "(types" not in join


def test_hits_of_views_by_bits_are_those_by_names(spark):
    rng = random.Random(6)
    items = spark.createDataFrame([(v, rng.choice(ITEM_NAMES)) for v in range(30) for _ in range(v % 7)], "view_id int, item string")
    hits = spark.createDataFrame([
        (n, rng.choice(ITEM_NAMES[::3] + ["unknown", None, None]), rng.choice(TYPE_NAMES), rng.choice([True, None, False]),
         (n % 3 + 0.5, n % 3 + 0.5, 0.5, 0.5)) for n in range(600)], f"id int, item string, rule_type string, selectable boolean, bbox {BOX}")
    boxes = view_boxes(spark, 30)
    by_name = op.selectable_hits(op.view_extract(hits, boxes), items)
    by_bits = op.selectable_hits(op.view_extract(op.with_needs(hits), op.with_choices(boxes, items)))
    assert sorted(by_bits.columns) == sorted(by_name.columns)
    columns = ["view_id", "id", "item", "rule_type"]
    assert sorted(map(str, by_bits.select(columns).collect())) == sorted(map(str, by_name.select(columns).collect()))
    assert by_bits.count() > 100


def test_hits_of_views_are_not_shuffled_for_their_choices(spark):
    items = spark.createDataFrame([(1, "place-label")], "view_id int, item string")
    hits = spark.createDataFrame([(1, "place-label", "place", True, (0.5, 0.5, 0.5, 0.5))],
                                 f"id int, item string, rule_type string, selectable boolean, bbox {BOX}")
    found = op.selectable_hits(op.view_extract(op.with_needs(hits), op.with_choices(view_boxes(spark, 3), items)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The outermost join is that of boxes, by cells.
    assert "_cell" in next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert [(r.view_id, r.id) for r in found.collect()] == [(1, 1)]


def test_views_are_not_repeated_for_each_file(spark, tmp_path):
    rows = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "land").otherwise("water").alias("type"), "id", F.struct(
            *((F.col("id") % 20 + n).cast("double").alias(side) for side, n in (("xmin", 0), ("xmax", 0.5), ("ymin", 0), ("ymax", 0.5)))).alias("bbox"))
    rows.repartition(8).write.partitionBy("type").parquet(f"{tmp_path}/r/theme=base")
    scanned = release.scan_release(spark, f"{tmp_path}/r")
    views = spark.createDataFrame([(n, (0.0, 30.0, 0.0, 30.0)) for n in range(50)] + [(50, (5.0, 6.0, 5.0, 6.0))] * 2, f"view_id int, box {BOX}")
    choices = spark.createDataFrame([(n, ["land"] if n % 2 else ["land", "water"]) for n in range(51)], "view_id int, types array<string>")
    found = catalog.extract_views(spark, catalog.file_manifest(scanned, f"{tmp_path}/r"), f"{tmp_path}/r", views, choices)
    assert found.count() == op.view_extract(scanned, views, choices).count() == 25 * 400 + 25 * 200 + 2 * 40
    join = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in line)
    assert "rel_path" not in join
