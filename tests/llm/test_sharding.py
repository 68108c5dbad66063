from collections import Counter, defaultdict
from zlib import crc32

import pytest

from mapsheaf.llm.queries import QUERIES
from mapsheaf.llm.sharding import pack


def check(rows, texts):
    assert Counter(r.doc_id for r in rows) == Counter(texts.keys())
    slots, where = defaultdict(list), defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, crc32(raw), "bytes", None)
        assert 0 <= r.shard < 8
        slots[r.shard].append(r.slot)
        where[texts[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return where


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_balances_and_keeps_groups(spark, scale):
    folder = f"/root/testdata/{scale}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op1_sharding"](spark, folder).collect()
    where = check(rows, texts)
    assert all(len(s) == 1 for s in where.values())
    for size in ("size", "n_tokens"):
        loads = Counter()
        for r in rows:
            loads[r.shard] += r[size]
        assert max(loads.values()) <= 1.03 * sum(loads.values()) / 8
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) <= 1.15 * len(rows) / 8


def test_a_group_above_a_share_is_cut(spark, corpus):
    texts = ["the same text of nine words for many rows"] * 500 + [f"text number {n} " * (n % 7 + 1) for n in range(1000)]
    rows = QUERIES["op1_sharding"](spark, corpus(texts)).collect()
    where = check(rows, dict(enumerate(texts)))
    assert 1 < len(where[texts[0]]) <= 5
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.1 * sum(loads.values()) / 8


def test_odd_rows(spark, odd_docs, no_docs):
    rows = pack(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = [r for r in rows if r.doc_id in (0, 1)]
    assert all((r.size, r.text_crc32) == (1, 0) for r in empty)
    assert pack(no_docs).count() == 0
