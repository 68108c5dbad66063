import random
import re
from hashlib import sha256

import pytest

from mapsheaf.llm.queries import QUERIES
from mapsheaf.llm.substrings import remove_repeats


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(texts, window=13):
    first = {}
    for n in sorted(texts):
        own = words(texts[n])
        for p in range(len(own) - window + 1):
            first.setdefault(tuple(own[p:p + window]), n)
    out = {}
    for n, text in texts.items():
        own = words(text)
        gone = set()
        for p in range(len(own) - window + 1):
            if first[tuple(own[p:p + window])] < n:
                gone.update(range(p, p + window))
        kept = " ".join(w for p, w in enumerate(own) if p not in gone)
        out[n] = (len(own), len(gone), kept)
    return out


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected = brute(texts)
    rows = QUERIES["op10_substring_dedup"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, gone, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize(("window", "bytes_"), [(3, 200), (5, 4 << 20)])
def test_shared_passages(spark, corpus, window, bytes_):
    rng = random.Random(window)
    letters = ["a", "b", "c", "dé", "e\x0bf", "\xa0g", "h"]
    common = " ".join(rng.choices(letters, k=40))
    texts = [None, "", common]
    for n in range(80):
        text = rng.choice([" ", "  ", "\t", "\n "]).join(rng.choices(letters, k=rng.randrange(40)))
        texts.append(text + (" " + common if n % 4 == 0 else ""))
    frame = spark.read.parquet(f"{corpus(texts)}/documents.parquet")
    expected = brute(dict(enumerate(texts)), window)
    rows = remove_repeats(frame, window, bytes_).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows} == expected


def test_crowded_counters_lose_nothing(spark, corpus):
    rng = random.Random(9)
    texts = [" ".join(rng.choices("abcde", k=30)) for _ in range(40)]
    frame = spark.read.parquet(f"{corpus(texts)}/documents.parquet")
    rows = remove_repeats(frame, 4, width_bits=4).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows} == brute(dict(enumerate(texts)), 4)


def test_odd_rows(odd_docs, no_docs):
    rows = remove_repeats(odd_docs, 2).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].kept == "" and by_id[7].n_removed == 4 and by_id[6].n_removed == 2
    assert by_id[None].n_removed == 0
    assert remove_repeats(no_docs).count() == 0
