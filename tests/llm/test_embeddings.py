import math

import numpy as np
import pytest

from mapsheaf.llm import embeddings
from mapsheaf.llm.embeddings import embedding_groups, quantise
from mapsheaf.llm.queries import QUERIES


def brute(rows, threshold):
    def usable(r):
        return (r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])
                and any(r[1]))

    links = {n: set() for n in range(len(rows))}
    for n, a in enumerate(rows):
        for m, b in enumerate(rows):
            if n != m and usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[n].add(m)
    out = []
    for n, row in enumerate(rows):
        seen, stack = {n}, [n]
        while stack:
            stack += [m for m in links[stack.pop()] if m not in seen and not seen.add(m)]
        out.append((row[0], len(links[n]), min(rows[m][0] for m in seen)))
    return sorted(out)


def result(frame):
    rows = frame.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in rows)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    assert result(QUERIES["op7_embedding_near_dedup"](spark, folder)) == brute(rows, 0.98)


@pytest.mark.parametrize("block", [3, 2048])
def test_many_tiles_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = []
    for n in range(90):
        base = rng.normal(size=8) if n % 3 == 0 else base + rng.normal(size=8) * 0.12  # noqa: F821
        rows.append((len(rows), [float(x) for x in base], int(n % 4 // 2)))
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, rows[0][1], None), (203, None, 0),
             (204, [], 0), (205, [0.0] * 8, 0), (206, [math.nan] + [1.0] * 7, 0),
             (207, [math.inf] * 8, 0), (208, [1.0] * 3, 0), (209, [None] * 8, 0),
             (210, [x * 3 for x in rows[0][1]], 0), (211, [1e-200] * 8, 0), (212, [1e200] * 8, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.selectExpr("*", "1 as rep", "'x' as digest", "0 as n_links")
    assert result(embedding_groups(frame, 0.98)) == brute(rows, 0.98)
    assert embedding_groups(frame.where("false")).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(300, 64)) ** 3
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes, scale, lost = quantise(unit)
    about = codes.astype(float) @ codes.T.astype(float) * scale[:, None] * scale
    assert (np.abs(about - unit @ unit.T) <= (1 + lost[:, None]) * lost + lost[:, None] + 1e-9).all()
