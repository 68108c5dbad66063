import random
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from mapsheaf.llm.common import components
from mapsheaf.llm.queries import QUERIES
from mapsheaf.llm.simhash import keep_one, links, simhash_groups


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[n:n + 3]) for n in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, limit):
    ids, root = list(prints), {}
    neighbours = defaultdict(list)
    for a in ids:
        for b in ids:
            if bin(prints[a] ^ prints[b]).count("1") <= limit:
                neighbours[a].append(b)
    for a in sorted(ids):
        stack = [] if a in root else [a]
        while stack:
            node = stack.pop()
            if node not in root:
                root[node] = a
                stack += neighbours[node]
    return root


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {k: brute_print(t) for k, t in texts.items()}
    expected = brute_components(prints, 2)
    got = QUERIES["op5_simhash_near_dedup"](spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        k: (f"{prints[k]:016x}", expected[k]) for k in prints}
    assert len(got) == len(texts)


def test_links_lose_nothing(spark):
    rng = random.Random(5)
    prints = {}
    for n in range(60):
        seed = rng.getrandbits(64)
        for _ in range(6):
            prints[len(prints)] = seed
            seed ^= 1 << rng.randrange(64)
    prints = {v: k for k, v in prints.items()}  # distinct
    rows = [(k, v - (1 << 64) if v >> 63 else v) for v, k in prints.items()]
    frame = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    for limit in (1, 2, 3, 5):
        got = {(r.low, r.high) for r in links(frame, limit).collect()}
        expected = {(a, b) for v, a in prints.items() for w, b in prints.items()
                    if a < b and bin(v ^ w).count("1") <= limit}
        assert got == expected


def test_odd_rows(spark, odd_docs, no_docs):
    got = simhash_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].fingerprint == "0" * 16
    assert by_id[0].component_id == by_id[1].component_id == by_id[13].component_id == 0
    assert by_id[4].fingerprint == by_id[5].fingerprint and by_id[5].component_id == 4
    assert by_id[7].component_id == 6
    assert simhash_groups(no_docs).count() == 0


def test_components_of_a_long_path(spark):
    path = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(path, "a", "b").collect()
    assert {r.node: r.component for r in got} == {n: 0 for n in range(201)}


def test_links_through_rows_without_id(spark, monkeypatch):
    prints = spark.createDataFrame([(1, 0, 0), (None, 0, 3), (2, 0, 15)], "doc_id long, row_key int, fingerprint long")
    monkeypatch.setattr("mapsheaf.llm.simhash.fingerprints", lambda docs, shingle: prints)
    rows = simhash_groups(spark.createDataFrame([], "doc_id long, text string"), 3, 2).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (None, 1), (2, 1)}


def test_keep_one_judges_rows(spark):
    texts = {k: " ".join(f"{k}{n * n}" for n in range(40)) for k in "ABCD"}
    rows = [(1, "A"), (2, "A"), (2, "B"), (None, "A"), (None, "A"), (5, "C"), (5, "D")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(n, texts[t], t) for n, t in order], "doc_id long, text string, row_key string")
        kept = keep_one(docs.repartition(3))
        assert kept.columns == docs.columns
        assert sorted((r.doc_id, r.row_key) for r in kept.collect()) == [(1, "A"), (2, "B"), (5, "C"), (5, "D")]


def test_keep_one_odd_rows(odd_docs, no_docs):
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and keep_one(no_docs).count() == 0
    groups = {r.component_id for r in simhash_groups(odd_docs).collect()}
    assert len(kept.collect()) == len(groups)
