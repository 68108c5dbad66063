"""A corpus pipeline over ``documents``: each stage works on what the one before kept.

1. language ID: documents whose language is not recognised go
2. SimHash near-dedup: of each group the document with the smallest id stays
3. benchmark decontamination: documents that overlap an item of ``benchmark`` go, also those
   that hold one of ``SHORT_ITEM`` to 12 tokens word for word
4. secret scans: documents that hold a secret go
5. byte-level BPE: the texts' token ids, and what they decode to

Every stage is written as Parquet and read again by the next. All but the last return the
columns of ``documents``. Null, empty and blank texts go in the first stage. Near-duplicates
are judged row by row, also without ``doc_id``; rows that share an id but not a text are two documents.
Stages that give texts to Python lower the session's limit for Arrow batches, see ``small_batches``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapsheaf.llm import bpe, decontaminate, langid, secrets, simhash
from mapsheaf.llm.common import materialize, table
from mapsheaf.llm.queries import BPE_RANKS
from mapsheaf.session import ship_package, small_batches


# The least tokens of a benchmark item that counts when it occurs whole.
SHORT_ITEM = 5


def recognised_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the folds 0 and 2 of three."""
    ship_package(spark)
    small_batches(spark)
    return langid.keep_recognised(docs, folds=3, held_out=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id, rows without id last.

    Rows that share an id but not a text are judged apart; of equal rows one stays.
    """
    ship_package(spark)
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), least=SHORT_ITEM)


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no secret."""
    return secrets.keep_clean(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the documents as tokens, and as text again."""
    ship_package(spark)
    small_batches(spark)
    coded = bpe.encode_decode(docs, bpe.load_ranks(BPE_RANKS), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("decoded"))


STAGES = [
    ("language_id", recognised_languages),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_free),
    ("secret_scan", secret_free),
    ("byte_bpe", encoded),
]

# Trained models and XXH64 are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
