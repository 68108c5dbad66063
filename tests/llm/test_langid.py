import random
from zlib import crc32

import pytest

from mapsheaf.llm import langid
from mapsheaf.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op6_language_id"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_prediction_uses_text_only(spark, corpus):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    fold = langid.hash_fold(docs.doc_id, 3)
    model = langid.fit(docs, fold != 1)
    texts = [r.text for r in docs.collect()]
    once, again = langid.predict(model, texts), langid.predict(model, texts[::-1])
    assert once[0] == again[0][::-1]
    languages, scores, rejected = langid.predict(model, ["", None, "123 !!", "漢字 текст", "the " * 300_000])
    assert languages[:3] == ["und"] * 3 and scores[:3] == [0.0] * 3 and rejected[:3] == [True] * 3
    assert rejected[3] and languages[3] in {r.lang for r in docs.select("lang").distinct().collect()}
    assert languages[4] == "en"


def test_pieces_of_a_long_text_add_up(monkeypatch):
    text = "Ångström über the straße 12 " * 400
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "PIECE", 101)
    assert (langid.counts(text) == whole).all()


def test_odd_rows(spark, odd_docs, no_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {0, 1, 2, 12, 13}
    kept = langid.keep_recognised(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(not r.rejected for r in rows)
    assert langid.identify(no_docs).count() == langid.keep_recognised(no_docs).count() == 0
    unlabelled = odd_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_a_language_left_out_is_rejected(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, (langid.hash_fold(docs.doc_id, 3) != 1) & (docs.lang != left_out))
    held = [r for r in docs.collect() if crc32(str(r.doc_id).encode()) % 3 == 1]
    rejected = langid.predict(model, [r.text for r in held])[2]
    strange = [x for x, r in zip(rejected, held, strict=True) if r.lang == left_out]
    clean = [x for x, r in zip(rejected, held, strict=True) if r.lang != left_out]
    assert sum(strange) >= 0.97 * len(strange)
    assert sum(clean) <= 0.02 * len(clean)
    rng = random.Random(5)
    noise = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=400)) for _ in range(50)]
    code = "for (int i = 0; i < argc; i++) { printf(argv[i]); } static void *xmalloc(size_t n) { return malloc(n); }"
    assert all(langid.predict(model, [*noise, code])[2])


def test_every_labelled_language_is_learned(spark):
    rng = random.Random(6)
    rows = []
    for n in range(70):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        for _ in range(1 if n == 69 else 4):
            rows.append((len(rows), " ".join(rng.choices(words, k=40)), f"l{n:02}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, docs.doc_id >= 0)
    assert set(model.languages) == {r[2] for r in rows}
    languages, _, rejected = langid.predict(model, [r[1] for r in rows])
    assert languages == [r[2] for r in rows] and not any(rejected)
    seen = sum((langid.counts(r[1]) > 0).astype(int) for r in rows)
    assert abs(model.rarity - (langid.np.log((1 + len(rows)) / (1 + seen)) + 1)).max() < 1e-5
