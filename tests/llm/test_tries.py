import random
from collections import defaultdict
from hashlib import md5, sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapsheaf.llm import tries
from mapsheaf.llm.parentheses import Parentheses
from mapsheaf.llm.tries import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in own:
        h = crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = sum(saved[k] for k in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children[node]), leaves[node],
                   saved[node], sha256(",".join(str(c) for c in m if len(rebuilt[c]) == len(node)).encode()).hexdigest())
                  for node, m in members.items())


def same(spark, rows, extra=()):
    conversations = spark.createDataFrame(rows, SCHEMA).withColumns(dict(extra)).repartition(3)
    got = sorted((tuple(r) for r in prefix_trie(conversations).collect()), key=lambda r: r[:2])
    assert got == sorted(brute(rows), key=lambda r: r[:2])
    return got


def talk(rng, count, longest, kinds=3):
    rows = []
    for conv in rng.sample(range(count * 2), count):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "é"]), f"t{rng.randrange(kinds)}" * rng.randrange(1, 3)))
    return rows


def test_parentheses():
    rng = random.Random(1)
    for _ in range(100):
        bits, depth, left = [], 0, rng.randrange(1, 400)
        while left or depth:
            if left and (not depth or rng.random() < rng.choice([0.3, 0.5, 0.9])):
                bits, depth, left = [*bits, 1], depth + 1, left - 1
            else:
                bits, depth = [*bits, 0], depth - 1
        runs, kind = [0], 0
        for bit in bits:
            if bit != kind:
                runs, kind = [*runs, 0], bit
            runs[-1] += 1
        stack, closes = [], {}
        for at, bit in enumerate(bits):
            if bit:
                stack.append(at)
            else:
                closes[stack.pop()] = at
        tree = Parentheses(np.array(runs))
        assert tree.find_close().tolist() == [closes[at] for at in tree.opens]


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = talk(rng, 60, 12)
    rows += [(7, None, None, None), (7, None, "user", None), (7, 1, "user", ""), (None, 1, "user", "lost"),
             (1000, 5, "a", "b"), (-7, 1, "x", "y"), (-10, 0, "x", "y"), (-10, 0, "x", "y"), (3, 10**12, "late", "z")]
    same(spark, rows, {"depth": F.lit(1), "n": F.lit(2), "path": F.lit("p"), "line": F.lit(0)}.items())


@pytest.mark.parametrize(("segment", "shard"), [(4, 12), (3, 1), (9, 10_000), (5, 40)])
def test_spines_merge_over_shards_and_units(spark, monkeypatch, segment, shard):
    monkeypatch.setattr(tries, "SEGMENT", segment)
    monkeypatch.setattr(tries, "SHARD", shard)
    rng = random.Random(segment)
    rows = talk(rng, 25, 2 * segment + 2, kinds=2)
    # One conversation of many turns, copies of one, and copies that go on apart.
    rows += [(500, n, "user", f"t{n % 2}") for n in range(9 * segment)]
    rows += [(600 + 5 * c, n, "user", "same") for c in range(12) for n in range(2 * segment)]
    rows += [(800 + 5 * c, n, "user", "same" if n < 3 * segment else f"{c % 2}") for c in range(4) for n in range(4 * segment)]
    same(spark, rows)


def test_copies_fill_many_shards(spark, monkeypatch):
    monkeypatch.setattr(tries, "SHARD", 50)
    rows = [(5 * c, n, "user", f"t{n}") for c in range(300) for n in range(2)] + talk(random.Random(4), 20, 5)
    got = same(spark, rows)
    assert max(r[3] for r in got) >= 300


def test_no_rows(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []


def test_odd_texts(spark):
    same(spark, [(0, 0, "user", "x" * 3_000_000), (1, 0, "user", "x" * 3_000_000 + "y"), (2, 0, "", "\U0001f600"), (3, 0, None, None)])
