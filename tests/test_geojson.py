"""Feature collections written by the data source."""

import json
import os

import pytest
from pyspark.sql import functions as F

from mapsheaf.sources import geojson

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"


def documents(out):
    found = {}
    for folder, _, names in os.walk(out):
        for name in names:
            if not name.startswith("."):
                with open(f"{folder}/{name}", encoding="utf-8") as file:
                    found[os.path.relpath(f"{folder}/{name}", out)] = json.load(file)
    return found


def places(spark, n, tasks=3):
    return spark.range(0, n, 1, tasks).select(
        F.when(F.col("id") % 4 == 0, "water").otherwise("place").alias("type"), F.col("id").cast("string").alias("id"),
        F.lit("Point").alias("geom_type"), F.lit('a "quoted"\nnäme').alias("name"),
        F.struct(*(F.col("id").cast("double").alias(s) for s in ("xmin", "xmax", "ymin", "ymax"))).alias("bbox"))


def test_each_file_is_a_document(spark, tmp_path):
    out = str(tmp_path / "out")
    geojson.export_collections(places(spark, 90), (0, 0, 79.5, 79.5), ["place", "water", "land"], out, features_per_file=10)
    found = documents(out)
    assert {name.split("/")[0] for name in found} == {"type=place", "type=water"}
    assert all(d["type"] == "FeatureCollection" and 0 < len(d["features"]) <= 10 for d in found.values())
    ids = sorted(int(f["properties"]["id"]) for d in found.values() for f in d["features"])
    assert ids == list(range(80))
    first = next(iter(found.values()))["features"][0]
    assert first["properties"]["name"] == 'a "quoted"\nnäme' and first["geometry"]["type"] == "Point"
    # A later export replaces it, and nothing staged is left.
    geojson.export_collections(places(spark, 5), (0, 0, 9, 9), ["place"], out)
    assert sorted(f["properties"]["id"] for d in documents(out).values() for f in d["features"]) == ["1", "2", "3"]
    assert not [name for name in os.listdir(out) if name.startswith("_staged")]
    geojson.export_collections(places(spark, 0), (0, 0, 9, 9), ["place"], out)
    assert documents(out) == {}


def test_a_failed_task_publishes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    geojson.export_collections(places(spark, 8), (0, 0, 9, 9), ["place"], out)
    before = documents(out)
    wrong = places(spark, 60).withColumn("name", F.when(
        F.col("id") == "59", F.raise_error(F.lit("damaged row"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="damaged row"):
        geojson.export_collections(wrong, (0, 0, 99, 99), ["place"], out)
    assert documents(out) == before


def test_rows_of_another_shape_are_refused(spark, tmp_path):
    spark.dataSource.register(geojson.FeatureCollections)
    with pytest.raises(Exception, match="type and value"):
        spark.range(3).write.format("feature_collections").mode("append").save(str(tmp_path / "out"))
