import __spark_entry__
import public_tokenizers
import pyarrow as pa
import tiktoken

import corpus_pipeline
from llm.test_decontaminate import tokens
from llm.test_secrets import brute as brute_secrets
from llm.test_simhash import brute_components, brute_print
from mapsheaf.llm import bpe, langid, secrets
from mapsheaf.llm.queries import BPE_RANKS
from mapsheaf.session import BATCH_BYTES, small_batches


def test_stages_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "byte_bpe"]

    before = {r.doc_id: r.text for r in docs.collect()}
    model = langid.fit(docs, langid.hash_fold(docs.doc_id, 3) != 1)
    rejected = dict(zip(before, langid.predict(model, list(before.values()))[2], strict=True))
    docs = stages["language_id"](spark, docs, folder).cache()
    assert docs.columns == columns
    after = {r.doc_id: r.text for r in docs.collect()}
    assert set(after) == {n for n in before if not rejected[n]} and len(after) >= 0.98 * len(before)

    root = brute_components({n: brute_print(t) for n, t in after.items()}, 2)
    docs = stages["simhash_near_dedup"](spark, docs, folder).cache()
    assert docs.columns == columns
    single = {r.doc_id: r.text for r in docs.collect()}
    assert single == {n: t for n, t in after.items() if root[n] == n} and len(single) < len(after)

    items = [" ".join(tokens(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    whole = {n for n, t in single.items() if any(f" {i} " in f" {' '.join(tokens(t))} " for i in items)}
    docs = stages["benchmark_decontamination"](spark, docs, folder).cache()
    assert docs.columns == columns
    clean = {r.doc_id: r.text for r in docs.collect()}
    assert whole and not whole & set(clean)
    assert len(clean) >= len(single) - 1.2 * len(whole)

    docs = stages["secret_scan"](spark, docs, folder).cache()
    assert docs.columns == columns
    safe = {r.doc_id: r.text for r in docs.collect()}
    held = {n for n, t in clean.items() if brute_secrets(t)}
    assert held and not held & set(safe)
    assert len(safe) >= len(clean) - len(held) - 0.005 * len(clean)

    codec = bpe.Codec(bpe.load_ranks(BPE_RANKS), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rows = stages["byte_bpe"](spark, docs, folder).collect()
    assert {r.doc_id: (r.ids, r.decoded) for r in rows} == {
        n: (library.encode_ordinary(t), t) for n, t in safe.items()}
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_run_and_odd_rows(spark, odd_docs, no_docs, tmp_path):
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        texts = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.decoded == texts[r.doc_id] for r in rows)
    assert "pipeline" in __spark_entry__.queries()
    assert secrets.LOG_ODDS > 0


def test_texts_reach_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(3000, numPartitions=1).selectExpr(
        "id AS doc_id", "repeat('word ', 2000) AS text", "'en' AS lang", "'s' AS source", "10000L AS n_chars")

    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.nbytes])], ["size"])

    try:
        for stage in ("language_id", "simhash_near_dedup", "byte_bpe"):
            spark.conf.set(name, "64MB")
            dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
            found = [r["size"] for r in docs.mapInArrow(sizes, "size long").collect()]
            assert sum(found) > 30_000_000 and max(found) < 2 * BATCH_BYTES
        spark.conf.set(name, "1m")
        small_batches(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)
