import random
from hashlib import sha256

import public_tokenizers
import tiktoken

from mapsheaf.llm import bpe, common
from mapsheaf.llm.queries import BPE_RANKS, QUERIES

CODEC = bpe.Codec(bpe.load_ranks(BPE_RANKS), public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def test_query_equals_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_byte_bpe"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()


def test_random_and_long_pieces():
    rng = random.Random(1)
    texts = ["", "a" * 2000, "ab" * 500 + "x", " " * 999 + "y", "the the  quick brown's fox\n\n x",
             "".join(rng.choice("etaoinshr") for _ in range(1500)),
             "".join(rng.choice("abAB01 \n.é漢\U0001f600") for _ in range(2000))]
    texts += ["".join(rng.choice("aeto nsi") for _ in range(rng.randrange(60))) for _ in range(300)]
    ids, decoded = CODEC.run(texts)
    for text, got, back in zip(texts, ids, decoded, strict=True):
        assert got.tolist() == LIBRARY.encode_ordinary(text)
        assert back.tobytes().decode() == text


def test_bounded_steps_and_memory(monkeypatch):
    monkeypatch.setattr(bpe, "HISTORY_ROWS", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "SLICE_CHARS", 40)
    texts = ["unbelievably antidisestablishmentarian words " * 3, "z" * 300, "short", ""]
    ids, decoded = bpe.Codec(bpe.load_ranks(BPE_RANKS), public_tokenizers.PATTERN).run(texts)
    assert [i.tolist() for i in ids] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [d.tobytes().decode() for d in decoded] == texts


def test_odd_rows(odd_docs, no_docs):
    ranks = bpe.load_ranks(BPE_RANKS)
    rows = bpe.encode_decode(odd_docs, ranks, public_tokenizers.PATTERN).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert bytes(r.decoded).decode() == (texts[r.doc_id] or "")
        assert r.ids == LIBRARY.encode_ordinary(texts[r.doc_id] or "")
    assert bpe.encode_decode(no_docs, ranks, public_tokenizers.PATTERN).count() == 0


def test_a_worker_keeps_the_codec_until_it_runs_something_else(monkeypatch):
    monkeypatch.setattr(common, "_kept", {})
    ranks = bpe.load_ranks(BPE_RANKS)
    first = bpe.codec(ranks, public_tokenizers.PATTERN)
    assert bpe.codec(ranks, public_tokenizers.PATTERN) is first
    common.keep_only("other", dict)
    assert list(common._kept) == ["other"]
    assert bpe.codec(ranks, public_tokenizers.PATTERN) is not first
    common.keep_only()
    assert common._kept == {}
