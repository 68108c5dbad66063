import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from mapsheaf.llm import lattice
from mapsheaf.llm.queries import QUERIES, UNIGRAM_MODEL

PIECES, START = lattice.vocabulary(UNIGRAM_MODEL)
WEIGHT = dict(zip(PIECES, START, strict=True))


def every_cut(text):
    if not text:
        yield 0.0
    for n in range(1, len(text) + 1):
        if text[:n] in WEIGHT:
            for rest in every_cut(text[n:]):
                yield WEIGHT[text[:n]] + rest


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return text.encode().split()


def brute_base(texts):
    counts = Counter()
    for n, text in texts.items():
        if crc32(str(n).encode()) % 10:
            counts.update([*words(text), None])
    total, distinct = sum(counts.values()), len(counts)
    return {n: (len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), total, sum(
        math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in [*words(t), None]))
        for n, t in texts.items()}


def test_forward_sums_every_cut():
    texts = [b" the", b" ab", b" caf\xc3\xa9", b" \xff", b" 12,."]
    found = lattice.Lattice(PIECES, START).log_probability(texts)
    for text, value in zip(texts, found, strict=True):
        assert value == pytest.approx(np.logaddexp.reduce(list(every_cut(text))), abs=1e-9)


def test_expected_pieces_cover_the_text():
    texts, counts = [b" hello", b" hello", b" " + b"z" * 200, b" word."], np.array([2.0, 1, 3, 4])
    used = lattice.Lattice(PIECES, START).expected(texts, counts)
    assert sum(len(p) * n for p, n in zip(PIECES, used, strict=True)) == pytest.approx(
        sum(len(t) * n for t, n in zip(texts, counts, strict=True)))


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected = brute_base(texts)
    rows = QUERIES["op4_lm_score"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    held, base = 0.0, 0.0
    for r in rows:
        tokens, known, total, score = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, total)
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
        held += r.score * r.held_out
        base += r.base_score * r.held_out
    bytes_ = sum(len(t.encode()) + 1 for n, t in texts.items() if crc32(str(n).encode()) % 10 == 0)
    assert -held / math.log10(2) / bytes_ < 4.0  # bits for each byte of the held-out texts


def test_score_is_a_sum_over_words(spark, corpus):
    texts = ["the cat sat", "the", "cat", "sat", "the cat", None, ""] * 5
    rows = {r.doc_id: r for r in QUERIES["op4_lm_score"](spark, corpus(texts)).collect()}
    by_text = {texts[n]: r.score for n, r in rows.items()}
    end = by_text[""]
    assert by_text[None] == end
    assert by_text["the cat sat"] - end == pytest.approx(sum(by_text[w] - end for w in ("the", "cat", "sat")))


def test_odd_rows(odd_docs, no_docs):
    rows = lattice.score(odd_docs, PIECES, START).collect()
    assert len(rows) == odd_docs.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert lattice.score(no_docs, PIECES, START).count() == 0


def test_training_texts_are_counted_whatever_their_number(spark):
    # The number of a block's training texts has bytes beyond 127.
    for size, training in ((216, 195), (260, 236)):
        rows = [(n, "the cat") for n in range(size)]
        assert sum(crc32(str(n).encode()) % 10 != 0 for n, _ in rows) == training
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        found = lattice.score(docs, PIECES, START).collect()
        tokens, known, total, score = brute_base(dict(rows))[0]
        assert {(r.n_tokens, r.n_known, r.train_tokens) for r in found} == {(tokens, known, total)}
        assert found[0].base_score == pytest.approx(score, rel=1e-9)


def test_held_out_texts_are_as_likely_as_by_word_counts(spark):
    rows = QUERIES["op4_lm_score"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > 1.15 * sum(r.base_score for r in rows)  # logarithms are negative
