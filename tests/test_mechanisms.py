"""Fingerprints, postings, adaptive bins, prefix sums by ranges and sketches, against plain counts."""
from __future__ import annotations

import random
import re
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regulus.operators import inventory, postings, quality, quantiles, sketches

ROWS = [(f"2026-0{1 + i % 4}", i, None if i % 5 == 0 else f"s{i % 3}", float(i % 7)) for i in range(200)]
SCHEMA = "m string, id long, s string, v double"


def differences(spark, rows):
    good, other = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(rows, SCHEMA)
    a, b = (quality.fingerprints(df, "m", ["id", "s", "v"]) for df in (good, other))
    cohorts = sorted(str(r["cohort"]) for r in quality.differing_cohorts(a, b).collect())
    found = quality.reconcile(good, other, "m", ["id", "s", "v"])
    want = Counter(ROWS)
    want.subtract(Counter(rows))
    got = {(r["m"], r["id"], r["s"], r["v"]): r["expected_copies"] - r["actual_copies"] for r in found.collect()}
    assert got == {k: n for k, n in want.items() if n}
    return cohorts


def test_fingerprints_find_what_differs(spark):
    mixed = random.Random(1).sample(ROWS, len(ROWS))
    assert differences(spark, mixed) == []
    altered = [("2026-02", 1, "other", 1.0) if r[1] == 1 else r for r in ROWS]
    assert differences(spark, altered) == ["2026-02"]
    assert differences(spark, ROWS + [ROWS[6]]) == ["2026-03"]  # doubled
    swapped = [(m, i, ROWS[11][2] if i == 3 else ROWS[3][2] if i == 11 else s, v) for m, i, s, v in ROWS]
    assert differences(spark, swapped) == ["2026-04"]
    assert differences(spark, [r for r in ROWS if r[0] != "2026-01"] + [(None, 0, None, 0.0)]) == ["2026-01", "None"]
    assert differences(spark, []) == ["2026-01", "2026-02", "2026-03", "2026-04"]
    assert differences(spark, [(m, i, s, -0.0 if v == 0 else v) for m, i, s, v in ROWS]) == []


def test_only_the_changed_cohort_is_read(spark, tmp_path, monkeypatch):
    for name, rows in (("a", ROWS), ("b", ROWS + [ROWS[6]])):
        spark.createDataFrame(rows, SCHEMA).write.partitionBy("m").parquet(str(tmp_path / name))
    a, b = (spark.read.schema(SCHEMA).parquet(str(tmp_path / n)) for n in "ab")
    prints = tuple(quality.fingerprints(df, "m", ["id", "s", "v"]) for df in (a, b))
    found = quality.reconcile(a, b, "m", ["id", "s", "v"], prints)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[.*?m#\d+ (?:IN|=|INSET)? ?.*?2026-03", plan)) == 2 and "2026-01" not in plan
    assert [(r["id"], r["actual_copies"]) for r in found.collect()] == [(6, 2)]
    monkeypatch.setattr(quality, "MOST_NAMED", 0)
    assert [(r["id"], r["actual_copies"]) for r in quality.reconcile(a, b, "m", ["id", "s", "v"]).collect()] == [(6, 2)]
    with pytest.raises(ValueError, match="types differ"):
        quality.reconcile(a, b.withColumn("id", F.col("id").cast("int")), "m", ["id"])


def test_search_reads_postings_only(spark, tmp_path):
    draw = random.Random(2)
    words = ["the", "The", "licence", "approval", "öl", "x1", "rare"]
    rows = [(i, " ".join(draw.choices(words, weights=[9, 9, 3, 3, 2, 2, 0.2], k=draw.randint(0, 30)))) for i in range(300)] + [(300, None), (301, "the-licence,öl!")]
    texts = spark.createDataFrame(rows, "id long, t string")
    postings.postings(texts, "id", "t", 8).sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    known = postings.frequencies(index)
    for terms in (["the"], ["The", "licence"], ["rare", "the", "öl"], ["licence", "unseen"], ["two words"], []):
        got = {r["id"]: r["score"] for r in postings.search(index, known, terms, "id", 8).collect()}
        if terms and all(t.isalnum() for t in terms):
            plain = {r["id"]: r["score"] for r in inventory.keyword_search(texts, terms, "id", "t").collect()}
            want = {i: sum(w in {t.lower() for t in terms} for w in re.findall(r"\w+", (t or "").lower())) for i, t in rows
                    if {x.lower() for x in terms} <= set(re.findall(r"\w+", (t or "").lower()))}
            assert got == plain == want
        else:
            assert got == {}
    plan = postings.search(index, known, ["rare", "the"], "id", 8)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "BroadcastHashJoin" in plan and "PushedFilters: [IsNotNull(term), EqualTo(term,the)" in plan


def test_quantiles_of_close_and_of_spread_values(spark):
    """A million values in [0, 1), one far outlier, and infinities: exact, and no last bin is large."""
    n = 1_000_000
    df = spark.range(n).selectExpr("'a' AS k", f"pmod(id * 7919, {n}) / {n}e0 AS v")
    df = df.unionByName(spark.createDataFrame([("a", 1e12)], "k string, v double"))
    got = {p: quantiles.exact_quantiles(df, ["k"], "v", p).first()["median"] for p in (0.5, 0.9)}
    assert got[0.5] == 0.5 and got[0.9] == pytest.approx(0.9, abs=2e-6)
    inf = float("inf")
    rows = [("b", v) for v in (-inf, 1.0, 2.0, 3.0, inf)] + [("c", 5.0)] * 3
    odd = {r["k"]: r["median"] for r in quantiles.exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert odd == {"b": 2.0, "c": 5.0}
    whole = spark.createDataFrame([("a", i) for i in (4, 1, 3, 9)], "k string, v int")
    assert quantiles.exact_quantiles(whole, ["k"], "v").first()["median"] == 3.5


def test_prefix_sums_spread_a_hot_day(spark):
    draw = random.Random(4)
    rows = [("hot" if i % 10 else draw.choice(["a", None]), 7 if i % 10 else draw.randint(0, 9), f"t{i:04}", draw.randint(1, 9)) for i in range(2000)]
    rows += [("hot", 7, "t0001", 5)] * 3
    df = spark.createDataFrame(rows, "k string, at int, name string, v int")
    out = quantiles.prefix_sums(df, ["k"], ["at", "name"], F.col("v"), "t", parts=8)
    got = Counter((r["k"], r["name"], r["t"]) for r in out.collect())
    want = Counter()
    for key in ("hot", "a", None):
        total = 0
        for k, at, name, v in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            want[key, name, total] += 1
            total += v
    assert sum(got.values()) == len(rows)
    single = {n for n, c in Counter((k, n) for k, _, n, _ in rows).items() if c == 1}
    assert {x for x in got if x[:2] in single} == {x for x in want if x[:2] in single}
    sizes = spark.read.parquet(re.findall(r"file:[^\s,\]]+", out._jdf.queryExecution().optimizedPlan().toString() + str(out.inputFiles()))[0].split("'")[0].rsplit("/", 1)[0]).groupBy("_part").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < len(rows) / 2


def test_sketches_merge_within_their_bound(spark):
    draw = random.Random(6)
    rows = [(f"m{i % 24}", draw.choice(["p", "p", "q", None]), int(draw.expovariate(0.01))) for i in range(30_000)] + [("m1", "r", None)]
    df = spark.createDataFrame(rows, "m string, p string, v int").cache()
    stored = sketches.sketches(df, ["m", "p"], F.col("v"))
    found = sketches.merged(stored, ["p"])
    checked = {r["p"]: (r["n"], r["within_bound"]) for r in sketches.within_bound(found, df, ["p"], F.col("v")).collect()}
    assert checked == {k: (sum(p == k for _, p, _ in rows), True) for k in ("p", "q", None)}
    for r in found.collect():
        own = [v for _, p, v in rows if p == r["p"]]
        assert abs(sum(v < r["median"] for v in own) / len(own) - 0.5) < 0.02 and abs(r["median"] - statistics.median(own)) < 5
    wrong = found.withColumn("median", F.col("median") + 40)
    assert not any(r["within_bound"] for r in sketches.within_bound(wrong, df, ["p"], F.col("v")).collect())
