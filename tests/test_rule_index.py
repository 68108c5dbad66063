"""The index of the rules finds what testing every rule finds, with far fewer tests."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from mapsheaf.operators.classify import classify_features
from mapsheaf.operators.rule_index import RuleIndex, classify_indexed, rule_index_counts
from mapsheaf.queries.fixture import features
from tests.test_rules import EXPLORE_CASES, INSPECT_CASES, SCHEMA, row


def cases(spark):
    rows = [
        row(f"{sign}{n}-{rule_id}", type_, **values)
        for n, (rule_id, (type_, _, good, bad)) in enumerate((EXPLORE_CASES | INSPECT_CASES).items())
        for sign, values in (("+", good), ("-", bad)) if values is not None]
    rows += [
        row("blank", "segment", "L", subtype="", class_=""),
        row("other", "segment", "L", subtype="road", class_="\x01"),
        row("missing", "segment", "L", subtype="road", class_="\x02"),
        row("unknown type", "volcano"), row("no type", None), row("same", "place", "P", category="pub", confidence=1.0),
        row("same", "place", "P", category="pub", confidence=1.0),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def found(frame):
    return Counter((r.id, r.rule_id, r.item, r.first_of_item) for r in frame.select(
        "id", "rule_id", "item", "first_of_item").collect())


@pytest.mark.parametrize("mode", ["explore", "inspect"])
def test_same_hits_as_without_index(spark, mode):
    rows = cases(spark)
    for zoom in (0, 4, 8.9, 9, 11, 13, 14, 16, 18):
        assert found(classify_indexed(rows, zoom, mode)) == found(classify_features(rows, zoom, mode)), zoom
    zooms = rows.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(18))))
    assert found(classify_indexed(zooms, F.col("zoom"), mode)) == found(
        classify_features(zooms, F.col("zoom"), mode))


def test_same_columns_and_extra_ones_kept(spark):
    rows = cases(spark).withColumn("residual", F.lit(1)).withColumn("a.b", F.lit(2))
    assert classify_indexed(rows, 14).schema == classify_features(rows, 14).schema


def test_missing_columns_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", "building", "Polygon")], "id string, type string, geom_type string")
    assert {r.item for r in classify_indexed(rows, 14).collect()} == {"building-footprint", "building-3d"}
    assert classify_indexed(rows.limit(0), 14).collect() == []


@pytest.mark.parametrize("mode", ["explore", "inspect"])
def test_index_is_small_and_no_row_is_shuffled(spark, mode):
    assert RuleIndex(F.col("zoom"), mode).table(spark).count() < 1000
    plan = classify_indexed(cases(spark), 16, mode)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_fewer_than_a_third_of_the_tests(spark):
    for zoom in (4, 10, 12, 14, 16):
        total = rule_index_counts(features(spark, "/root/testdata/sf0.001"), zoom).agg(
            F.sum("tests_without_index").alias("all"), F.sum("tests_left").alias("left")).first()
        assert 3 * total.left < total["all"], zoom


def test_only_own_tests_are_evaluated(spark):
    # A test that fails on every row it sees must not be seen by rows of other residuals.
    index = RuleIndex(16)
    guarded = index.candidates(spark.createDataFrame(
        [row("a", "segment", "L", subtype="road", class_="trunk")], SCHEMA)).select(
        F.filter("@candidates", lambda entry: F.when(entry["residual"].isNotNull(), F.raise_error(
            F.lit("tested")).cast("boolean")).otherwise(True)).alias("hits"))
    assert len(guarded.first().hits) == 3
