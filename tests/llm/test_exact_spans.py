import random
from hashlib import sha256

import numpy as np
import pytest

from mapsheaf.llm import suffixes, words
from mapsheaf.llm.exact_spans import remove_repeated_bytes
from mapsheaf.llm.queries import QUERIES
from mapsheaf.llm.suffixes import prefix_classes, ranks


def brute(texts, length=100):
    seen, out = set(), {}
    for n in sorted(texts):
        raw = (texts[n] or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            part = raw[p:p + length]
            if part in seen:
                gone[p:p + length] = True
            seen.add(part)
        spans = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[n] = (len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes())
    return out


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected = brute(texts)
    rows = QUERIES["op3_suffix_dedup"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, gone, spans, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, spans, sha256(kept).hexdigest())


@pytest.mark.parametrize(("length", "bytes_", "hot"), [(16, 300, 2), (20, 4 << 20, 32), (100, 2000, 3)])
def test_shared_passages(spark, corpus, length, bytes_, hot):
    # Small blocks, and anchors that are split as soon as a few of them hold one.
    rng = random.Random(length)
    common = "".join(rng.choices("abcdé ", k=3 * length))
    texts = [None, "", common, "a" * 5 * length, "ab" * 4 * length]
    for n in range(60):
        cut = sorted(rng.randrange(len(common)) for _ in range(2))
        edges = ["".join(rng.choices("abcdefgh", k=rng.randrange(3 * length))) for _ in range(2)]
        texts.append(edges[0] + (common[cut[0]:cut[1]] if n % 2 else common) + edges[1])
    frame = spark.read.parquet(f"{corpus(texts)}/documents.parquet")
    rows = remove_repeated_bytes(frame, length, bytes_, hot).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == brute(
        dict(enumerate(texts)), length)


def test_odd_rows(odd_docs, no_docs):
    rows = remove_repeated_bytes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9].n_removed == 4999 and by_id[9].n_spans == 1
    assert by_id[0].n_bytes == 0
    assert remove_repeated_bytes(no_docs).count() == 0


def test_ranks_order_prefixes():
    rng = random.Random(3)
    for _ in range(200):
        size, kinds, length = rng.randrange(1, 50), rng.choice([1, 2, 3, 5]), rng.choice([1, 2, 3, 4, 9, 10, 50])
        text = [rng.randrange(1, kinds + 1) for _ in range(size)]
        found = ranks(np.array(text), length)
        for i in range(size):
            for j in range(size):
                if text[i:i + length] != text[j:j + length]:
                    assert (found[i] < found[j]) == (text[i:i + length] < text[j:j + length])


def test_classes_of_prefixes():
    rng = random.Random(5)
    for _ in range(30):
        unit = bytes(rng.choices(b"ab", k=rng.choice([1, 7, 40, 250])))
        text = bytearray((unit * 800)[:rng.randrange(130, 700)])
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = 122
        starts = np.arange(len(text) - 99)
        found = prefix_classes(np.frombuffer(bytes(text), np.uint8), starts, 100)
        kinds = {}
        assert all(kinds.setdefault(bytes(text[n:n + 100]), found[n]) == found[n] for n in starts)
        assert len(kinds) == len(set(found.tolist()))


def test_rolling_hashes_are_those_of_the_words():
    rng = np.random.default_rng(5)
    for size, length in ((1, 1), (50, 50), (51, 50), (3000, 16), (200_000, 50)):
        data = rng.integers(0, 256, size, np.uint8)
        starts = np.arange(size - length + 1)
        assert (words.rolling(data, length) == words.hashes(data, starts, starts + length)).all()


def test_names_are_the_same_whether_or_not_keys_fit_one_number():
    rng = np.random.default_rng(6)
    keys = tuple(rng.integers(0, 5, 400) for _ in range(3))
    wide = tuple(key << 40 for key in keys)
    order, rank = suffixes._named(keys)
    assert (rank == suffixes._named(wide)[1]).all()
    rows = sorted(set(zip(*map(np.ndarray.tolist, keys), strict=True)))
    assert [rows.index(row) + 1 for row in zip(*map(np.ndarray.tolist, keys), strict=True)] == rank.tolist()
    assert (np.diff(rank[order]) >= 0).all()
    assert suffixes._named((np.empty(0, np.int64),))[1].tolist() == []
