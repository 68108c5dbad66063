import random

import pytest
from pyspark.sql import functions as F

from mapsheaf.operators import indexes
from mapsheaf.sources.release import scan_release

BOX = "struct<xmin:double,xmax:double,ymin:double,ymax:double>"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("release"))
    frame = spark.range(4000).select(
        F.concat(F.lit("f"), "id").alias("id"), F.expr("CASE id % 2 WHEN 0 THEN 'land' ELSE 'water' END").alias("type"),
        F.expr("named_struct('xmin', id / 100D, 'xmax', id / 100D, 'ymin', 0D, 'ymax', 0D)").alias("bbox"))
    frame.repartition(40, "id").write.partitionBy("type").parquet(f"{folder}/theme=base")
    return folder


def test_lookup_reads_the_files_of_its_ids(spark, root, tmp_path):
    index = str(tmp_path / "ids")
    features = scan_release(spark, root)
    indexes.write_id_index(features, index, buckets=16)
    ids = spark.createDataFrame([("f7",), ("f7",), ("f3999",), ("nowhere",), (None,), ("f40",)], "id string")
    files = [r.filename for r in indexes.indexed_files(spark, index, ids, 16).collect()]
    every = features.select("filename").distinct().count()
    assert 1 <= len(files) <= 3 and every > 50
    found = indexes.indexed_lookup(spark, root, index, ids, 16)
    assert {r.id: r.type for r in found.collect()} == {"f7": "water", "f3999": "water", "f40": "land"}
    assert sorted(found.inputFiles()) == sorted(f.replace("file:/", "file:///") if "///" not in f else f for f in files)
    # Only folders of the ids' buckets are read.
    plan = indexes.indexed_files(spark, index, ids, 16)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    none = spark.createDataFrame([("nowhere",)], "id string")
    assert indexes.indexed_lookup(spark, root, index, none, 16) is None


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_similar_words_lose_none(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("aabcdé", k=rng.randrange(1, 7))) for _ in range(400)} | {"aaaaaaa", "abababab"})
    asked = rng.sample(words, 60) + ["".join(rng.choices("aabcdé", k=rng.randrange(2, 8))) for _ in range(60)] + ["aaaaaa", "abababa"]
    asked = sorted({w for w in asked if len(w) > 1})
    grams = spark.createDataFrame([(w, 1) for w in words], "word string, carried long").select(
        F.explode(indexes._grams(F.col("word"))).alias("gram"), "word", "carried")
    for errors in (0, 1):
        found = indexes.similar_words(grams, spark.createDataFrame([(w,) for w in asked], "asked string"), errors)
        assert {(r.asked, r.word, r.errors) for r in found.collect()} == {
            (a, w, d) for a in asked for w in words if (d := edits(a, w)) <= errors}


def test_search_forgives_a_letter_and_finds_inner_words(spark, tmp_path):
    rows = [("1", "Old Harbour Road"), ("2", "harbour"), ("3", "Harbor View"), ("4", "Road"), ("5", None), ("6", "A 1"),
            *((f"x{n}", f"Road {n}") for n in range(50))]
    frame = spark.createDataFrame(rows, "id string, name string").select(
        "id", F.lit("t").alias("theme"), F.lit("u").alias("type"), F.lit(None).cast("string").alias("subtype"),
        F.struct(F.col("name").alias("primary"), F.lit(None).cast("map<string,string>").alias("common"),
                 F.lit(None).cast("array<struct<between:array<double>>>").alias("rules")).alias("names"))
    index = str(tmp_path / "names")
    indexes.write_name_index(frame, index, 6)
    texts = ["harbuor", "HARBOR", "raod harbour", "rood harbor", "road", "a 1", "b 1", "h", "", None, "zzzz road", "road 4"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    found = {}
    for r in sorted(indexes.indexed_search(spark, index, queries).collect(), key=lambda r: r.position):
        found.setdefault(texts[r.query_id], []).append(r.id)
    assert found["harbuor"] == ["3"]
    assert found["HARBOR"] == ["3", "2", "1"]
    assert "raod harbour" not in found and found["rood harbor"] == ["1"]
    assert found["road"][:3] == ["1", "4", "x0"] or found["road"][0] in ("1", "4")
    assert len(found["road"]) == 6 and found["a 1"][0] == "6" and "b 1" not in found
    assert "h" not in found and "" not in found and "zzzz road" not in found
    assert found["road 4"][0] == "x4"


def test_a_name_of_many_features_is_compared_once(spark, tmp_path):
    # 300 features share two names; the best of them by name and id are wanted, repeated rows counted once.
    rows = [(f"f{n:03}", "Road 7" if n % 2 else "Road 8") for n in range(300)] + [("f001", "Road 7")]
    frame = spark.createDataFrame(rows, "id string, name string").select(
        "id", F.lit("t").alias("theme"), F.lit("u").alias("type"), F.lit(None).cast("string").alias("subtype"),
        F.struct(F.col("name").alias("primary"), F.lit(None).cast("map<string,string>").alias("common"),
                 F.lit(None).cast("array<struct<between:array<double>>>").alias("rules")).alias("names"))
    index = str(tmp_path / "names")
    indexes.write_name_index(frame, index, 6)
    queries = spark.createDataFrame([(0, "raod 7"), (1, "8 road")], "query_id int, text string")
    found = indexes.indexed_search(spark, index, queries)
    kept = {(r.query_id, r.position): (r.id, r.errors) for r in found.collect()}
    assert {at: held for at, held in kept.items() if at[0] == 1} == {(1, n + 1): (f"f{2 * n:03}", 0) for n in range(6)}
    assert (0, 1) not in kept  # two letters changed places, which is two edits
    judged = found._jdf.queryExecution().optimizedPlan().toString().split("levenshtein")
    assert len(judged) > 1 and "Aggregate [word#" in found._jdf.queryExecution().optimizedPlan().toString()
