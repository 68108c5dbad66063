import random
import re
import time
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from mapsheaf.llm import secrets
from mapsheaf.llm.queries import QUERIES

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def written(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check(row, text):
    base = brute(text)
    assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
    assert row.base_sha256 == sha256(written(base).encode()).hexdigest()
    spans = [s for s in row.spans.split(",") if s]
    assert [s for s in spans if not s.startswith("random:")] == [s for s in written(base).split(",") if s]
    assert len(spans) == len(base) + row.n_random
    assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op2_secret_scan"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        check(row, texts[row.doc_id])


def test_patterns_and_places(spark, corpus):
    rng = random.Random(2)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    texts = [None, "", "é\U0001f600 TOKEN = 'abcdefgh' secret:short token=token:abcdefghijk",
             "AKIA" + "Q7" * 8 + " AKIAAKIAAKIAAKIA AKIAAA", "f" * 31 + " " + "f" * 32 + "g" + "0" * 33,
             "passwd=\"" + "a/b+c=" * 3 + "\"", " ".join(f"api_key: {h}" for h in hexes),
             "plain_identifier_name another_ordinary_variable some_function_argument " * 40]
    texts += [f"token = {h} in some_ordinary_identifier and other_common_name" for h in hexes]
    rows = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, corpus(texts)).collect()}
    for n, text in enumerate(texts):
        check(rows[n], text)
    assert rows[7].n_random == 0


def test_markov_chains_tell_random_from_ordinary(spark):
    rng = random.Random(4)
    letters = "0123456789abcdefghijklmnopqrstuvwxyz"
    words = ["connection", "handler", "document", "default", "session", "language", "threshold", "component"]
    ordinary = ["_".join(rng.sample(words, 3)) for _ in range(300)]
    strange = ["".join(rng.choice(letters) for _ in range(30)) for _ in range(300)]
    samples = spark.createDataFrame(
        [(w, False) for w in ordinary[:200]] + [(w, True) for w in strange[:200]], "value string, random boolean")
    ratios = secrets.train(samples)
    test = spark.createDataFrame([(w, n) for n, w in enumerate(ordinary[200:] + strange[200:])], "value string, n int")
    odds = {r.n: r.odds for r in test.select("n", secrets.log_odds(F.col("value"), ratios).alias("odds")).collect()}
    assert all(odds[n] < secrets.LOG_ODDS for n in range(100))
    assert all(odds[n] >= secrets.LOG_ODDS for n in range(100, 200))


def test_short_random_tokens(spark):
    rng = random.Random(9)
    letters = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ratios = secrets.train(secrets.sample_values(docs))
    keys = ["".join(rng.choices(letters, k=k)) for k in (12, 14, 16, 19) for _ in range(25)]
    numbers = ["".join(rng.choices("0123456789", k=k)) for k in (12, 16, 19) for _ in range(5)]
    rows = [(n, f"and the {value} of it") for n, value in enumerate(keys + numbers)]
    found = secrets.with_spans(spark.createDataFrame(rows, "doc_id long, text string"), ratios)
    spans = {r.doc_id: [tuple(s) for s in r["__spans"]] for r in found.collect()}
    hit = [n for n, key in enumerate(keys) if spans[n] == [(8, 3, 8 + len(key))]]
    assert len(hit) >= 90 and set(range(50, 100)) <= set(hit)
    assert not any(spans[n] for n in range(len(keys), len(rows)))


def test_odd_rows(odd_docs, no_docs):
    assert secrets.scan(odd_docs).count() == odd_docs.count()
    assert secrets.keep_clean(odd_docs).columns == odd_docs.columns
    assert secrets.keep_clean(odd_docs).count() == odd_docs.count() - 1  # 5,000 times "a" is hexadecimal
    assert secrets.scan(no_docs).count() == secrets.keep_clean(no_docs).count() == 0


@pytest.mark.parametrize("count", [1, 2, 17])
def test_prefix_sums(spark, count):
    steps = list(range(1, count + 1))
    got = spark.range(1).select(secrets._prefix_sums(F.array(*map(F.lit, steps)))).first()[0]
    assert got == [sum(steps[:n]) for n in range(count)]


def test_text_of_many_matches(spark, corpus):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(20_000)]
    texts = [" ".join(words), " ".join(f"token={w}" for w in words[:5_000]), None]
    began = time.monotonic()
    rows = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, corpus(texts)).collect()}
    assert time.monotonic() - began < 60
    for n, text in enumerate(texts):
        check(rows[n], text)


def test_planted_random_strings_are_spans_of_the_query(spark, tmp_path):
    rng = random.Random(12)
    letters = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    keys = {n: "".join(rng.choices(letters, k=24)) for n in range(0, 1000, 25)}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table = spark.createDataFrame(list(keys.items()), "doc_id long, key string")
    planted = docs.join(table, "doc_id", "left").withColumn(
        "text", F.when(F.col("key").isNotNull(), F.concat(F.lit("use "), "key", F.lit(" now "), "text")).otherwise(F.col("text")))
    planted.drop("key").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, str(tmp_path)).collect()}
    # Those that look like identifiers are also learned as such, so not all reach the odds.
    found = [n for n in keys if rows[n].spans.startswith("random:4:28")]
    assert len(found) >= 0.8 * len(keys)
    assert sum(r.n_random for r in rows.values()) <= len(keys) + 5
