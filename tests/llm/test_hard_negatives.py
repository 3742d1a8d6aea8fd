from __future__ import annotations

import numpy as np
import pytest

from compare import compare
from regulus.llm.cover_tree import Asked, CoverTree
from regulus.llm.hard_negatives import labelled_vectors, mine
from regulus.llm.queries import ORACLES, QUERIES


def brute(rows, anchor_ids, positives=5, negatives=3, low=50, high=95):
    out = []
    for a, label, q in sorted({(i, n, tuple(x)) for i, n, x in rows if i in anchor_ids}):
        scored = [(int(sum(u * v for u, v in zip(q, x))), i, n) for i, n, x in rows]
        best = sorted((-s, i) for s, i, n in scored if n == label and i != a)[:positives]
        for s, i in best:
            own = sorted((-t, j) for t, j, n in scored if n != label and j != a and low * -s <= 100 * t <= high * -s)[:negatives]
            out += [(a, i, r + 1, j, -s, -t) for r, (t, j) in enumerate(own)]
    return sorted(out)


def clustered(n, seed, width=12, centres=9):
    random = np.random.default_rng(seed)
    middle = random.integers(-90, 90, (centres, width))
    x = middle[random.integers(0, centres, n)] + random.integers(-12, 12, (n, width))
    x[n // 3:n // 3 + 40] = x[n // 3]
    x[:n // 10] = random.integers(-90, 90, (n // 10, width))
    return [(i * 2, int(k), [float(v) for v in row]) for i, (row, k) in enumerate(zip(x, random.integers(0, 4, n)))]


def test_query_against_sql(spark, duck, sf_dir):
    assert compare(QUERIES["op11_hard_negatives"](spark, sf_dir), duck, ORACLES["op11_hard_negatives"]) is None


@pytest.mark.parametrize("block,anchors", [(8192, 4096), (170, 30)])
def test_clusters_ties_and_blocks(spark, block, anchors):
    rows = clustered(800, 3)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, vector array<double>, unit string, block int").cache()
    got = mine(df.where("vec_id % 50 = 0"), df, block=block, anchor_block=anchors)
    want = brute(rows, {i for i, _, _ in rows if i % 50 == 0})
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_the_tree_covers_and_separates():
    rows = clustered(1500, 5)
    tree = CoverTree(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    seen, waiting = [], [0]
    while waiting:
        node = waiting.pop()
        if tree.members[node] is not None:
            seen += tree.members[node].tolist()
            under = tree.members[node]
        else:
            own = tree.children[node]
            centres = np.array([tree.centre[c] for c in own])
            assert tree.centre[own[0]] == tree.centre[node]  # a centre stays one on the levels below
            if len(own) > 1:
                apart = tree._distances(centres, centres) + 1e9 * np.eye(len(own))
                assert apart.min() > tree.level[own[0]] - 1e-4
            assert all(tree.radius[c] <= tree.level[c] + 1e-4 for c in own)
            waiting += own.tolist()
            continue
        assert tree._distances(under, np.array([tree.centre[node]])).max() <= tree.radius[node] + 1e-4
    assert sorted(seen) == list(range(1500))


def test_descents_skip_what_lies_outside():
    """Of far clusters only a few nodes are opened; answers are those of brute force, windows from above included."""
    random = np.random.default_rng(8)
    centres = random.integers(-200, 200, (40, 16))
    x = (centres[np.repeat(np.arange(40), 100)] + random.integers(-3, 3, (4000, 16))).astype(float)
    ids, labels = np.arange(4000), np.repeat(np.arange(2), 2000)
    tree = CoverTree(ids, labels, x)
    q = x[:1]
    scores = x @ q[0]
    for low, high in ((-np.inf, np.inf), (scores.max() * 0.3, scores.max() * 0.5), (scores.max() * 2, np.inf)):
        asked = Asked(np.zeros(1, dtype=int), np.array([low]), np.array([high]), np.array([0]), np.array([0]), False, 3)
        (rows, got), = tree.search(q, asked)
        fit = np.flatnonzero((scores >= low) & (scores <= high) & (labels != 0))
        want = fit[np.lexsort((ids[fit], -scores[fit]))][:3]
        assert rows.tolist() == want.tolist() and got.tolist() == scores[want].tolist()
        assert tree.opened < len(tree.centre) / 3


def test_copies_make_one_leaf():
    tree = CoverTree(np.arange(3000), np.zeros(3000), np.ones((3000, 4)))
    asked = Asked(np.zeros(1, dtype=int), np.array([-np.inf]), np.array([np.inf]), np.array([0]), np.array([7]), True, 9)
    (rows, scores), = tree.search(np.ones((1, 4)), asked)
    assert rows.tolist() == [0, 1, 2, 3, 4, 5, 6, 8, 9] and len(tree.centre) == 1


def test_unusable_vectors_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [0.5, -0.25]), (1, 1, None), (2, 1, [0.5, None]), (3, 2, [nan, 1.0]), (4, 2, [inf, 1.0]), (5, None, [0.1, 0.1]), (None, 1, [1.0, 1.0]),
            (6, 1, [1.0]), (7, 2, [0.25, 0.1]), (7, 2, [0.25, 0.1]), (8, 2, [-1.0, 0.0]), (9, 1, []), (0, 1, [0.5, -0.25])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, vector string")
    v = labelled_vectors(df)
    own = [(r.vec_id, r.label, r.vector) for r in v.collect()]
    assert sorted(own, key=str) == sorted([(0, 1, [128.0, -64.0])] * 2 + [(6, 1, [256.0]), (7, 2, [64.0, 25.0]), (7, 2, [64.0, 25.0]), (8, 2, [-256.0, 0.0]), (9, 1, [])], key=str)
    got = sorted(map(tuple, mine(v.where("vec_id = 0"), v, low=10).collect()))
    assert got == brute(own, {0}, low=10) == [(0, 6, 1, 7, 32768, 6592), (0, 6, 2, 7, 32768, 6592)]
    assert mine(v.limit(0), v).collect() == [] and mine(v.where("vec_id = 0"), v.where("vec_id = 0")).collect() == [] and mine(v, v.limit(0)).collect() == []


def test_negative_scores_have_no_window(spark):
    rows = [(0, 1, [10.0]), (1, 1, [-5.0]), (2, 2, [-3.0]), (3, 1, [0.0]), (4, 2, [0.0]), (50, 1, [-4.0])]
    df = spark.createDataFrame(rows, "vec_id long, label long, vector array<double>")
    got = sorted(map(tuple, mine(df.where("vec_id % 50 = 0"), df).collect()))
    assert got == brute(rows, {0, 50}) and (0, 3, 1, 4, 0, 0) in got
