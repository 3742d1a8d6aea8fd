from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from regulus.llm import mixing
from regulus.llm.mixing import flight, landing, mix, settled
from regulus.llm.queries import QUERIES


def expected_targets(sizes):
    """Targets by sharing the excess anew until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, fixed = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in fixed)
        open_ = [s for s in names if s not in fixed]
        target = {s: 3.0 * sizes[s] if s in fixed else left * weight[s] / sum(weight[t] for t in open_) for s in names}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            return target
        fixed |= over


def check(rows):
    """rows: (source, size, source_size, target, taken)."""
    sizes, taken, most, number = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int)
    for source, size, *_ in rows:
        sizes[source] += size
        number[source] += 1
        most[source] = max(most[source], size)
    want = expected_targets(dict(sizes))
    for source, size, source_size, target, took in rows:
        assert source_size == sizes[source] and target == pytest.approx(want[source])
        assert 0 <= took <= 3 * size and (size == 0 or took % size == 0)
        taken[source] += took
    for source in sizes:
        # a few documents cannot come nearer than the largest of them
        near = 0.005 * want[source] if number[source] >= 40 else most[source]
        assert abs(taken[source] - want[source]) <= near, (source, taken[source], want[source])


def test_flight_keeps_totals():
    random = np.random.default_rng(1)
    sizes = random.integers(1, 500, 3000).astype(float)
    p = np.full(3000, 0.37)
    out = flight(p, sizes, random)
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and out @ sizes == pytest.approx(p @ sizes)
    final = landing(out, sizes, random)
    assert set(final) <= {0.0, 1.0} and abs(final @ sizes - p @ sizes) <= sizes.max()


def test_landing_makes_up_for_large_documents():
    """Units of every size wait for the landing: totals come within a few words, although some documents have thousands."""
    for seed in range(20):
        random = np.random.default_rng(seed)
        sizes = np.exp(random.normal(5.5, 1.2, 400)).round() + 1
        sizes[:3] = 20_000
        p = np.full(400, random.uniform(0.1, 0.9))
        out = settled(p, sizes, True, random)
        assert set(out) <= {0.0, 1.0} and abs(out @ sizes - p @ sizes) <= 0.015 * (p @ sizes) and abs(out.sum() - p.sum()) <= 64
    few = settled(np.full(5, 0.4), np.array([1.0, 2, 3, 4, 5]), True, np.random.default_rng(1))
    assert few @ np.arange(1, 6) == 6
    assert settled(np.zeros(0), np.zeros(0), True, np.random.default_rng(1)).tolist() == []


def test_equal_rows_make_many_blocks(spark, monkeypatch):
    """Twenty thousand equal rows are dealt to ten blocks or more, and their number is right."""
    seen = []
    original = mixing._settle
    monkeypatch.setattr(mixing, "_settle", lambda units, block, *a: seen.append(units.withColumn("b", block).groupBy("b").count().collect()) or original(units, block, *a))
    df = spark.range(20_000).selectExpr("7L as doc_id", "'a b c' as text", "'hot' as source").unionByName(
        spark.range(300).selectExpr("id as doc_id", "repeat('w ', cast(id as int)) as text", "'b' as source")).repartition(6)
    got = mix(df, carry=("doc_id",)).groupBy("source").agg({"target": "max", "source_size": "max"}).collect()
    assert len(got) == 2 and len(seen[0]) >= 10 and max(r["count"] for r in seen[0]) < 4000
    taken = {r["source"]: r["t"] for r in mix(df).groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("t")).collect()}
    want = {r["source"]: r["max(target)"] for r in got}
    assert all(abs(taken[s] - want[s]) <= 3 for s in want)


def test_query(spark, sf_dir):
    source = {r.doc_id: (r.source, len(re.findall("[^\x20\x09-\x0d]+", r.text))) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    first = QUERIES["op6_mixing"](spark, sf_dir).collect()
    assert len(first) == len(source) and all(source[r.doc_id][1] == r["size"] for r in first)
    check([(source[r.doc_id][0], r["size"], r.source_size, r.target, r.taken) for r in first])
    again = QUERIES["op6_mixing"](spark, sf_dir)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first))


def test_blocks_nulls_and_repeated_rows(spark):
    random = np.random.default_rng(5)
    rows = [(int(i) if i % 9 else None, " ".join("w" * int(n)) if n else None, ["hot", "b", None, "c", "empty"][0 if i % 3 else int(random.integers(1, 4))], 1)
            for i, n in enumerate(random.integers(0, 40, 1500))]
    rows += rows[:200] + [(7, "", "empty", 2), (8, None, "empty", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mix(df, block=100, carry=("doc_id",)).collect()
    assert len(got) == len(rows)
    check([(r.source, r["size"], r.source_size, r.target, r["size"] * r.times) for r in got])
    shuffled = mix(df.orderBy("text").repartition(5), block=100, carry=("doc_id",)).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, got))


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string"), carry=("doc_id",)).collect() == []
