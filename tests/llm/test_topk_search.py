from __future__ import annotations

import numpy as np
import pytest

from compare import compare
from regulus.llm.queries import ORACLES, QUERIES
from regulus.llm.topk_search import Lists, top_k, whole_vectors


def brute(rows, query_ids, k):
    out = []
    for q, qx in rows:
        if q not in query_ids:
            continue
        scored = sorted((-sum(a * b for a, b in zip(qx, x)), c) for c, x in rows if c != q)
        out += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def test_query_against_sql(spark, duck, sf_dir):
    assert compare(QUERIES["op4_topk_search"](spark, sf_dir), duck, ORACLES["op4_topk_search"]) is None


@pytest.mark.parametrize("block", [8192, 150])
def test_clusters_ties_and_blocks(spark, block):
    random = np.random.default_rng(2)
    centres = random.integers(-90, 90, (12, 16))
    x = centres[random.integers(0, 12, 900)] + random.integers(-9, 9, (900, 16))
    x[100:140] = x[100]
    rows = [(i * 3, [float(v) for v in x[i]]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").cache()
    got = top_k(df.where("vec_id % 30 = 0"), df, block=block, query_block=40)
    assert sorted(map(tuple, got.collect())) == brute(rows, {i for i, _ in rows if i % 30 == 0}, 5)


def test_reading_stops_early(monkeypatch):
    """With clear winners the lists are not read to their ends."""
    random = np.random.default_rng(4)
    x = random.integers(-60, 60, (4000, 8)).astype(float)
    x[:30] = 200
    ids = np.arange(4000)
    monkeypatch.setattr("regulus.llm.topk_search.STRETCHES", (0.25,))  # no further stretch is there
    found = Lists(ids, x).search(np.array([0]), x[:1], 5)
    assert ids[found[0][0]].tolist() == [1, 2, 3, 4, 5]


def test_unusable_vectors_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, None), (2, [0.5, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.1, 0.1]), (5, [0.1, 0.1]), (None, [1.0, 1.0]), (6, [1.0]), (7, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, vector string, block int")
    v = whole_vectors(df)
    assert sorted((r.vec_id, r.vector) for r in v.collect()) == [(0, [128.0, -64.0]), (5, [25.0, 25.0]), (5, [25.0, 25.0]), (6, [256.0]), (7, [])]
    got = sorted(map(tuple, top_k(v.where("vec_id = 0"), v).collect()))
    assert got == [(0, 1, 6, 128 * 256), (0, 2, 5, 1600), (0, 3, 5, 1600), (0, 4, 7, 0)]
    assert top_k(v.limit(0), v).collect() == [] and top_k(v.where("vec_id = 0"), v.where("vec_id = 0")).collect() == []
