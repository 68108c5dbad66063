import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from mapsheaf.llm import collocations as operator
from mapsheaf.llm.collocations import collocations, phrase_counts


def brute(rows, least, longest, top):
    grams, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    grams[lang][tuple(words[i:i + size])] += 1
    out = set()
    for lang, counts in grams.items():
        found = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        longer = Counter()
        for p, c in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i:i + size]] = max(longer[p[i:i + size]], c)
        scored = []
        for p, a in found.items():
            if 100 * longer[p] >= 100 * a:
                continue
            score, k = min((1000 * a * totals[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def same(spark, rows, least=3, longest=5, top=40):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = [tuple(r) for r in collocations(docs, least, longest, top).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, least, longest, top)
    return got


def test_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "b", "The", "é", "É", "\U0001f600", "x-y", "Z" * 40, "q", "r"]
    stops = [" ", " ", " ", " ", "\t", ", ", ".\n", "\x0b", " : "]
    rows = [(rng.choice(["en", "fr", None, ""]), "".join(
        rng.choice(words) + rng.choice(stops) for _ in range(rng.randrange(60)))) for _ in range(120)]
    rows += [("en", "once upon a time there was"), ("en", None), ("fr", ""), ("fr", " \t ..,")] * 4
    got = same(spark, rows, top=400)
    assert {len(r[2].split(" ")) for r in got} >= {2, 3}
    assert len(same(spark, rows, top=3)) == 3 * len({r[0] for r in got})
    same(spark, rows, longest=3)


def test_ties_copies_and_hot_pair(spark):
    """One pair holds most rows; equal scores are ordered by phrase."""
    rows = [("en", "hot pair")] * 500 + [("en", f"u{n} v{n}") for n in range(9) for _ in range(4)]
    got = same(spark, rows, least=4)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])][:2] == ["u0 v0", "u1 v1"]


def test_text_longer_than_a_chunk(spark):
    text = "alpha beta gamma, delta epsilon. " * 400_000  # 13 MB
    got = same(spark, [("en", text), ("en", "x" * 9_000_000), ("en", "word " * 10)], least=100)
    assert ("alpha beta gamma", 400_000) in {(r[2], r[3]) for r in got}


def test_exact_beyond_64_bits(spark):
    counted = spark.createDataFrame([("en", "a", "b", 4_000_000_000_000), ("en", "a", "", 10)], "lang string, w1 string, w2 string, n long")
    rows = {tuple(r.words): r.f for r in phrase_counts(counted, 2, 1).collect()}
    assert rows == {("a", "b"): 4_000_000_000_000}
    got = spark.sql("select (cast(1000 as decimal(4,0)) * cast(4000000000000 as decimal(16,0))) * cast(9000000000001"
                    " as decimal(19,0)) div (cast(4000000000010 as decimal(19,0)) * cast(4000000000000 as decimal(19,0)))").first()[0]
    assert got == 1000 * 4000000000000 * 9000000000001 // (4000000000010 * 4000000000000)


def test_odd_rows(odd_docs, no_docs):
    odd = odd_docs.withColumns({"rank": F.lit(1), "phrase": F.lit("p"), "n": F.lit(1), "w1": F.lit("w")})
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert {tuple(r) for r in collocations(odd, 2).collect()} == brute(rows, 2, 5, 2000)
    assert collocations(no_docs).collect() == []
    assert collocations(no_docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_windows_are_summed_within_a_task_and_start_beyond_pairs(spark, monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"] * 2, "w1": ["a", w], "n": [1, 2]}) for w in ("b", "c", "b")]
    rows = pa.Table.from_batches(operator._summed(iter(batches))).to_pylist()
    assert sorted((r["w1"], r["n"]) for r in rows) == [("a", 3), ("b", 4), ("c", 2)]
    monkeypatch.setattr(operator, "SUMMED", 1)
    assert sum(r["n"] for r in pa.Table.from_batches(operator._summed(iter(batches))).to_pylist()) == 9

    made = []
    spied = operator.windows
    monkeypatch.setattr(operator, "windows", lambda *args: made.append(spied(*args)) or made[-1])
    same(spark, [("en", "a b, c d e, f")] * 4 + [("fr", "a b")] * 4)
    assert {tuple(r)[1:4] for r in made[0].collect()} == {("c", "d", "e")}


def test_words_of_one_hash(spark, monkeypatch):
    """A Thue-Morse word and its opposite have the same polynomial hash modulo 2^64."""
    bits = [n.bit_count() & 1 for n in range(2048)]
    one, other = ("".join("ab"[b ^ turned] for b in bits) for turned in (0, 1))
    shared = []
    asked = operator.share_hashes
    monkeypatch.setattr(operator, "share_hashes", lambda *args: shared.append(asked(*args)) or shared[-1])
    same(spark, [("en", f"x {one} y z")] * 5 + [("en", f"x {other} y z")] * 4 + [("en", f"{one} y, x")] * 2)
    same(spark, [("en", f"x {one} y z")] * 5 + [("en", f"x {other} y z")])
    same(spark, [("en", "x a y z")] * 5)
    assert shared == [True, True, False]
