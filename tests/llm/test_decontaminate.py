import random
import re

import corpus_pipeline
from mapsheaf.llm import decontaminate
from mapsheaf.llm.queries import QUERIES, SQL


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    found = {}
    for d, text in docs.items():
        a = tokens(text)
        for i, item in items.items():
            b = tokens(item)
            for diagonal in range(-len(b), len(a)):
                low, high = max(0, diagonal), min(len(a), diagonal + len(b))
                equal = [a[p] == b[p - diagonal] for p in range(low, high)]
                if any(sum(equal[k:k + 13]) >= 11 for k in range(len(equal) - 12)):
                    found[d, i] = max(found.get((d, i), (0, 0, 0)), (sum(equal), len(equal), -low))
    return {k: (m, n, -p) for k, (m, n, p) in found.items()}


def planted(rng):
    words = [f"w{n}" for n in range(400)]
    items = {n: " ".join(rng.choices(words, k=rng.choice([5, 12, 13, 14, 20, 40]))) for n in range(30)}
    docs = {}
    for n in range(120):
        body = rng.choices(words, k=rng.randrange(0, 60))
        if n % 3:
            own = items[rng.randrange(30)].split()
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = "changed"
            cut = rng.randrange(0, 4)
            body[len(body) // 2:len(body) // 2] = own[cut:]
        docs[n] = " ".join(body)
    docs[200] = None
    return docs, items


def test_masks_hit_every_window():
    for a in range(13):
        for b in range(13):
            equal = [n not in (a, b) for n in range(13)]
            assert any(all(equal[p + k] for k, bit in enumerate(mask) if bit == "1")
                       for mask in decontaminate.MASKS for p in range(13 - len(mask) + 1))


def test_planted_passages(spark, monkeypatch):
    docs, items = planted(random.Random(7))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame([*items.items(), (90, None), (91, ""), (None, "x")], "item_id long, text string")
    expected = brute(docs, items)
    assert expected
    for limit in (decontaminate.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", limit)
        monkeypatch.setattr(decontaminate, "BROADCAST_HITS", limit)
        rows = decontaminate.overlaps(frame, tests).collect()
        assert {(r.doc_id, r.item_id): (r.matched, r.aligned, r.doc_start) for r in rows} == expected
    kept = {r.doc_id for r in decontaminate.keep_clean(frame, tests).collect()}
    assert kept == set(docs) - {d for d, _ in expected}


def test_query_finds_whole_items(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: " ".join(tokens(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: " ".join(tokens(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, item in items.items() if f" {item} " in f" {t} "}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontamination"](spark, folder).collect()}
    assert whole and whole <= found
    assert "op8_decontamination" in SQL


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "x y " * 20), (2, None)], "item_id long, text string")
    rows = decontaminate.overlaps(odd_docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(10, 1)}
    assert decontaminate.keep_clean(odd_docs, items).columns == odd_docs.columns
    assert decontaminate.keep_clean(odd_docs, items).count() == odd_docs.count() - 1
    assert decontaminate.overlaps(no_docs, items).count() == 0
    assert decontaminate.overlaps(odd_docs, items.where("false")).count() == 0
    assert decontaminate.keep_clean(odd_docs, items.where("false")).count() == odd_docs.count()


def test_short_items_word_for_word(spark, tmp_path):
    items = [(1, "What is the capital of Peru?"), (2, "one two three four"), (3, " ".join(f"q{n}" for n in range(12))), (4, None)]
    docs = {0: "Q: what IS the capital, of peru", 1: "what is the capital of Chile", 2: "one two three four five", 3: None,
            4: "x " + " ".join(f"q{n}" for n in range(12)), 5: "", 6: " ".join(f"q{n}" for n in range(11))}
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, frame, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6]
