"""Expressions and operators against literal values and brute force."""
from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from changes import DAY, done, fact
from regulus.contract import FACT_SCHEMA
from regulus.functions import columns as x
from regulus.operators import (
    answers, document, inventory, kpi, latest, marts, measurements as m, performance, quality,
    quantiles, selfservice, semantic,
)


def facts(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in FACT_SCHEMA.fieldNames()) for r in rows], FACT_SCHEMA)


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


POINT_SCHEMA = ("process_code string, kpi_id string, reporting_quarter string, baseline double, "
                "target double, numerator bigint, denominator bigint, value double")


def points(spark, rows):
    return spark.createDataFrame(rows, POINT_SCHEMA)


def test_met_and_shortfall_literals(spark):
    rows = kpi.indicator_scores(points(spark, [
        ("MA", "pct_x", "Q1 2026", 50.0, 90.0, 95, 100, 95.0),
        ("MA", "median_turnaround_time", "Q1 2026", 50.0, 60.0, 1, 1, 100.0),
        ("MA", "pct_none", "Q1 2026", None, None, 1, 1, 10.0),
        ("MA", "pct_null", "Q1 2026", 1.0, 2.0, 1, 1, None)])).collect()
    by = {r["kpi_id"]: r for r in rows}
    assert (by["pct_x"]["met"], by["pct_x"]["shortfall"], by["pct_x"]["unit"]) == (True, -5.0, "%")
    slow = by["median_turnaround_time"]
    assert (slow["met"], slow["shortfall"], slow["unit"]) == (False, 40.0, "days")
    assert by["pct_none"]["met"] is None and by["pct_none"]["shortfall"] is None
    assert "pct_null" not in by


def test_status_bands(spark):
    def light(kpi_id, v, t):
        return one(spark, s=x.light_status(F.lit(kpi_id), F.lit(v).cast("double"), F.lit(t).cast("double")))["s"]

    def step(a, t):
        return one(spark, s=x.step_status(F.lit(a), F.lit(t)))["s"]
    assert light("pct_a", 95.0, 100.0) == "warning" and light("pct_a", 94.9, 100.0) == "error"
    assert light("avg_a", 105.0, 100.0) == "warning" and light("avg_a", 105.1, 100.0) == "error"
    assert light("avg_a", None, 100.0) == "unknown" and light("pct_a", 1.0, None) == "unknown"
    assert step(105.0, 100.0) == "error" and step(104.9, 100.0) == "warning"
    assert one(spark, s=x.target_status(F.lit("median_x"), F.lit(3.0), F.lit(3.0)))["s"] == "Met target"
    # "avg" without the underscore is not a duration
    assert one(spark, s=x.target_status(F.lit("avgx"), F.lit(3.0), F.lit(4.0)))["s"] == "Below target"


def test_whole_days_are_complete_24_hours(spark):
    ms = 3_600_000

    def days(a, b):
        return one(spark, d=x.whole_days(F.lit(a), F.lit(b)))["d"]
    assert days(23 * ms, 2 * 24 * ms + ms) == 1        # two midnights, one whole day
    assert days(0, 24 * ms - 1) == 0
    assert days(900, 24 * ms + 100) == 1               # milliseconds go before the difference
    assert days(2 * 24 * ms, 0) == -2


def test_quarters_and_text(spark):
    r = one(spark, q=x.quarter_label(F.lit(1_783_000_000_000)), n=x.quarter_label(F.lit(None).cast("long")),
            i=x.quarter_index(F.lit("Q3 2026")), b=x.label_of_index(F.lit(2026 * 4 + 2)),
            d=x.quarter_start(F.lit("Q4 2026")).cast("string"), s=x.slug(F.lit("  a b/c!! ")),
            e=x.slug(F.lit("!!")), z=x.sanitized(F.lit("On-site  Foreign")),
            m=x.masked(F.lit("e1")), c=x.last_token(F.lit("a_b_c")), k=x.last_token(F.lit("abc")))
    assert (r["q"], r["n"], r["i"], r["b"], r["d"]) == ("Q3 2026", None, 8106, "Q3 2026", "2026-10-01")
    assert (r["s"], r["e"], r["z"]) == ("a-b/c", "unnamed", "on_site_foreign")
    assert (r["c"], r["k"]) == ("c", None)
    import hashlib
    assert r["m"] == "sha256:" + hashlib.sha256(b"e1").hexdigest().upper()


def test_step_suffix_first_match_wins(spark):
    r = one(spark, a=x.base_step(F.lit("Plan_reliance_joint_on_site_foreign")),
            b=x.base_step(F.lit("Plan_domestic_applicant")), c=x.base_step(F.lit("Plan")),
            d=x.is_disaggregated(F.lit("Plan_foreign")))
    assert tuple(r) == ("Plan_reliance_joint_on_site", "Plan", "Plan", True)


def test_rounding_is_stable_on_halves(spark):
    r = one(spark, a=x.rounded(F.lit(14.949999999999998), 1), b=x.rounded(F.lit(0.1) + F.lit(0.15), 1),
            c=x.ratio(F.lit(1), F.lit(0)), d=x.percent(F.lit(1), F.lit(3)))
    assert (r["a"], r["b"], r["c"]) == (15.0, 0.3, None)
    assert abs(r["d"] - 100 / 3) < 1e-12


def test_quantiles_against_brute_force(spark):
    rng = random.Random(5)
    rows = [("hot", rng.choice([rng.random() * 400, float(rng.randint(0, 9))])) for _ in range(4000)]
    rows += [(f"g{i % 7}", rng.random() * 5) for i in range(200)] + [("one", 3.0), ("one", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for p in (0.5, 0.9):
        got = {r["k"]: r["q"] for r in quantiles.exact_quantiles(df, ["k"], "v", p, out="q").collect()}
        want = {r["k"]: r["q"] for r in df.groupBy("k").agg(F.percentile("v", p).alias("q")).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert abs(got["one"] - 3.0) < 1e-12
    median = quantiles.exact_quantiles(df, ["k"], "v").filter("k = 'hot'").first()["median"]
    assert abs(median - statistics.median(v for k, v in rows if k == "hot")) < 1e-9


def test_weighted_quantile_equals_repeated_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.0, 4)], "k string, v double, n int")
    assert quantiles.exact_quantiles(df, ["k"], "v", weight="n").first()["median"] == 5.5


def test_running_total_against_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 5}", rng.randint(0, 30), i, rng.randint(1, 9)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, b int, o int, v int")
    got = {r["o"]: r["t"] for r in quantiles.running_total_before(
        df, ["k"], F.col("b"), ["o"], F.col("v"), "t").collect()}
    for k, b, o, _ in rows:
        assert got[o] == sum(v2 for k2, b2, o2, v2 in rows if k2 == k and (b2, o2) < (b, o))


def test_latest_state_of_a_hot_key(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("revision"), (F.col("id") * 2).alias("v"))
    now = latest.latest_state(df, ["k"], ["revision"])
    assert now.count() == 6001
    assert now.filter("k = 'hot'").first()["revision"] == 8997
    assert latest.nth_latest(df, ["k"], "revision", 2).collect()[0]["revision"] == 8994
    past = latest.state_as_of(df, ["k"], ["revision"], 5000, clock="v")
    assert past.filter("k = 'hot'").first()["revision"] == 2499


def test_valid_and_quarantine_partition_the_input(spark):
    rows = [fact("r1", 1), fact("r2", 1, due_at=None), fact("r3", 1, tenant_id=None),
            fact("r4", 0), fact("r5", 1, touch_days=None), fact("r6", 1, due_at=9 * DAY)]
    df = facts(spark, rows)
    assert [r["record_id"] for r in quality.valid(df).collect()] == ["r1"]
    assert quality.quarantine(df).count() == 5
    bad = {r["record_id"]: r["violations"] for r in quality.constraint_violations(df).collect()}
    assert bad["r2"] == ["dates"] and bad["r5"] == ["measures"] and "r3" not in bad


def test_moved_identity_and_orphans(spark):
    df = facts(spark, [fact("r1", 1), fact("r1", 2, cohort_month="2026-02"), fact("r2", 1)])
    assert [r["record_id"] for r in quality.moved_identities(df).collect()] == ["r1"]
    apps = facts(spark, [fact("a2", 1)])
    assert quality.orphans(df, apps).count() == 3
    diff = quality.multiset_difference(df, facts(spark, [fact("r1", 1)]), ["record_id"])
    assert {(r["record_id"], r["expected_copies"], r["actual_copies"]) for r in diff.collect()} == {
        ("r1", 2, 1), ("r2", 1, 0)}


def test_two_indicator_paths_and_branches_agree(spark, sf_dir):
    from regulus.sources import gold
    acts = gold.valid_activities(spark, sf_dir)
    joined, branches = m.measurements(acts), m.measurements_by_branches(acts)
    assert quality.multiset_difference(joined, branches, joined.columns).isEmpty()
    keys = ["process_code", "kpi_id", "reporting_quarter"]
    single = acts.withColumn("tenant_id", F.lit("all"))
    a = kpi.kpi_quarterly(m.measurements(single)).select(*keys, "numerator", "denominator", "value")
    b = kpi.kpi_from_facts(acts).select(*keys, F.col("numerator").alias("n"),
                                        F.col("denominator").alias("d"), F.col("value").alias("v"))
    both = a.join(b, keys, "full_outer").filter(
        ~(F.col("n").eqNullSafe(F.col("numerator")) & F.col("d").eqNullSafe(F.col("denominator"))
          & (F.abs(F.col("v") - F.col("value")) < 1e-9)))
    assert both.isEmpty()


def test_measurement_rules(spark):
    rows = [done("r1", 1), done("r2", 1, activity_type="inspection", process_code="GMP", route="on_site_foreign"),
            done("r3", 1, status="IN_REVIEW"), done("r4", 1, process_code="GMP", activity_type="inspection",
                                                    route=None)]
    got = {(r["activity_id"], r["kpi_id"]) for r in m.measurements(facts(spark, rows)).collect()}
    assert {k for a, k in got if a == "r2"} == {
        "pct_facilities_inspected_on_time", "pct_facilities_inspected_on_time_on_site_foreign",
        "pct_facilities_compliant", "pct_facilities_compliant_on_site_foreign"}
    assert not [g for g in got if g[0] == "r3"]
    assert {k for a, k in got if a == "r4"} == {"pct_facilities_inspected_on_time", "pct_facilities_compliant"}


def test_steps_need_only_a_completion(spark):
    rows = [done("s1", 1, activity_type="Step", status="CANCELLED")]
    assert performance.step_performance(facts(spark, rows)).count() == 1
    assert m.completed(facts(spark, rows)).count() == 0


def test_missing_observation_is_absent_and_volumes_fill_zero(spark):
    apps = facts(spark, [fact("a1", 1, activity_type="application")])
    acts = facts(spark, [done("x1", 1)])
    assert kpi.kpi_from_facts(acts).filter("kpi_id = 'pct_fir_responses_on_time'").isEmpty()
    v = performance.quarterly_volumes(apps, acts)
    assert v.filter("metric = 'fir_sent'").first()["value"] == 0
    assert performance.inspection_volumes(acts).isEmpty()


def test_tenant_marts_add_up(spark, sf_dir):
    from regulus.sources import gold
    apps = gold.applications(spark, sf_dir)
    everything = marts.application_throughput(apps, 10 ** 12).agg(F.sum("applications_received")).first()[0]
    tenants = [r["tenant_id"] for r in apps.select("tenant_id").distinct().collect()]
    parts = [marts.application_throughput(marts.for_tenant(apps, t), 10 ** 12)
             .agg(F.sum("applications_received")).first()[0] for t in tenants]
    assert len(tenants) == 3 and sum(parts) == everything == apps.count()
    with pytest.raises(ValueError):
        marts.for_tenant(apps.drop("tenant_id"), "x")


def test_weighted_and_unweighted_ratios_differ(spark):
    rows = spark.createDataFrame([("r", "p", 9, 10, 90.0), ("r", "p", 0, 1, 0.0)],
                                 "handling_route string, process string, compliant_count int, "
                                 "assessments int, pct_compliant double")
    got = semantic.metric_query({"quality_metrics": rows}, [
        "quality_metrics_compliance_rate", "quality_metrics_pct_compliant"], ["handling_route"]).first()
    assert round(got["quality_metrics_compliance_rate"], 2) == 81.82
    assert got["quality_metrics_pct_compliant"] == 45.0
    with pytest.raises(KeyError):
        semantic.metric_query({"quality_metrics": rows}, ["quality_metrics_assessments"], ["colour"])


def test_percent_change_is_chronological(spark):
    wide = spark.createDataFrame([("Q1 2023", 10.0), ("Q1 2024", 30.0), ("Q2 2023", 20.0)], "quarter string, a double")
    got = {r["quarter"]: r["a"] for r in selfservice.percent_change(wide, ["a"]).collect()}
    assert got == {"Q2 2023": 100.0, "Q1 2024": 50.0}


def test_trend_answer(spark):
    rows = [("MA", "pct_a", "Q1 2026", 1.0, 90.0, 1, 1, 50.0), ("MA", "pct_a", "Q2 2026", 1.0, 90.0, 1, 1, 60.0),
            ("MA", "avg_b", "Q1 2026", 1.0, 90.0, 1, 1, 50.0), ("MA", "avg_b", "Q2 2026", 1.0, 90.0, 1, 1, 53.0),
            ("MA", "pct_c", "Q1 2026", 1.0, 90.0, 1, 1, 50.0), ("MA", "pct_c", "Q2 2026", 1.0, 90.0, 1, 1, 50.4)]
    got = answers.trend_answer(points(spark, rows), "Q1 2026", "Q2 2026").first()
    assert (got["improving"], got["declining"], got["little_change"]) == (1, 1, 1)
    assert got["worst_indicator"] == "avg_b"


def test_backlog_against_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(150):
        received = 1_700_000_000_000 + rng.randint(0, 500) * DAY + rng.randint(0, DAY)
        completed = None if rng.random() < 0.3 else received + rng.randint(0, 200) * DAY
        rows.append(fact(f"r{i}", 1, received_at=received, completed_at=completed, process_code="MA"))
    got = performance.backlog(facts(spark, rows), ["process_code"]).collect()
    assert got
    for r in got:
        q, year = int(r["quarter"][1]), int(r["quarter"][3:])
        import datetime as dt

        def ms(y, month):
            return int(dt.datetime(y, month, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
        start = ms(year, 3 * q - 2)
        end = ms(year + (q == 4), 1 if q == 4 else 3 * q + 1)
        open_at = lambda t: [f for f in rows if f["received_at"] < t and (
            f["completed_at"] is None or f["completed_at"] >= t)]
        ages = [(end - f["received_at"]) // DAY for f in open_at(end)]
        assert r["opening_backlog"] == len(open_at(start)) and r["closing_backlog"] == len(ages)
        assert [r["age_0_30"], r["age_31_60"], r["age_61_90"], r["age_90_plus"]] == [
            sum(a <= 30 for a in ages), sum(30 < a <= 60 for a in ages),
            sum(60 < a <= 90 for a in ages), sum(a > 90 for a in ages)]


def test_document_sections(spark, tmp_path):
    long = spark.createDataFrame(
        [("quarterlyData", "MA", "k", "Q1 2024", "value", 2.0), ("quarterlyData", "MA", "k", "Q4 2023", "value", 1.0)],
        "section string, process string, name string, quarter string, measure string, value double")
    docs = document.documents(long)
    body = docs.first()["body"]
    assert body.index("Q4 2023") < body.index("Q1 2024")
    assert document.flatten(docs).count() == 2
    assert document.missing_sections(docs, ("quarterlyData", "kpiCounts")) == ["kpiCounts"]
    docs.write.json(str(tmp_path / "d"))
    with pytest.raises(ValueError, match="lacks sections"):
        document.read_documents(spark, str(tmp_path / "d"))


def test_search_requires_every_term(spark):
    texts = spark.createDataFrame(
        [(1, "Licence approvals, granted."), (2, "licence"), (3, "Approvals of a LICENCE licence")], "id int, t string")
    got = {r["id"]: r["score"] for r in inventory.keyword_search(texts, ["licence", "approvals"], "id", "t").collect()}
    assert got == {1: 2, 3: 3}


def test_export(spark, tmp_path):
    from regulus.sources import export
    df = facts(spark, [fact(f"r{i}", 1) for i in range(10)])
    assert export.export_rows(df, "silver", "2026-01", 5, 3).count() == 3
    assert export.export_rows(df, "silver", "2026-02", 5, 3).count() == 0
    assert export.export_rows(df, "bronze", "2026-02", 5, 30).count() == 5
    with pytest.raises(PermissionError):
        export.export_rows(df, "silver", "2026-01", 5, 0)
    with pytest.raises(export.TooManyRows):
        export.guarded(df, 9)
    assert export.guarded(df, 10).count() == 10
    export.write_csv(df.select("record_id", "revision").repartition(4), str(tmp_path / "csv"))
    import glob
    assert len(glob.glob(str(tmp_path / "csv" / "*.csv"))) == 1
    text = open(glob.glob(str(tmp_path / "csv" / "*.csv"))[0], "rb").read()
    assert text.startswith("﻿record_id,revision\n".encode())


def test_regression_significance(spark):
    from regulus.functions.stats import correlation_p_value
    assert abs(correlation_p_value(0.5, 10) - 0.14111) < 1e-4
    assert abs(correlation_p_value(-0.9, 12) - 6.6e-05) < 1e-5
    assert correlation_p_value(1.0, 9) == 0.0 and correlation_p_value(0.3, 2) is None
    pairs = spark.createDataFrame([(float(i), 2.0 * i + (i % 3)) for i in range(20)], "x double, y double")
    row = selfservice.significance(selfservice.regression(pairs, "x", "y")).first()
    assert row["strength"] == "Strong" and row["significant"] and row["p_value"] < 1e-10


def test_name_based_ids(spark):
    import uuid
    got = one(spark, a=x.name_uuid(F.lit("lineage:job ü")))["a"]
    assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, "lineage:job ü"))


def test_other_families_have_no_measurements(spark, tmp_path):
    from changes import envelope, write_batch
    from regulus.streaming import changelog
    from regulus.streaming.medallion import Medallion
    steps = Medallion(str(tmp_path / "lake"), "steps")
    write_batch(spark, str(tmp_path / "in"), "b0", [envelope("c", done("s1", 1)), envelope("r", done("s2", 1))], 0)
    steps.apply(spark.read.schema(changelog.RAW_SCHEMA).json(str(tmp_path / "in" / "*")), 0, "r")
    assert steps.gold(spark).count() == 2
    assert steps.measurements(spark).isEmpty()


def test_a_removed_gold_table_is_written_again(spark):
    from regulus.sources import gold
    from regulus.streaming.runs import remove
    first = gold.stored(spark, "nowhere", "numbers", lambda: spark.range(5))
    path = gold._written[(spark.sparkContext.applicationId, "nowhere", "numbers")][0]
    assert first.count() == 5 and remove(spark, [path]) == 1
    assert gold.stored(spark, "nowhere", "numbers", lambda: spark.range(7)).count() == 7


def test_groups_with_null_keys_stay(spark):
    """Every form of a report has the same groups, null keys among them."""
    from regulus.operators import marts, performance
    from regulus.operators.quantiles import exact_quantiles
    rows = [done(f"r{i}", 1, days=i + 1, activity_type=None if i % 2 else "decision", route=None if i % 3 == 0 else "on_site_domestic") for i in range(12)]
    df = facts(spark, rows)
    plain = marts.turnaround_performance(df).collect()
    exact = marts.turnaround_performance(df, exact_median=True).collect()
    key = lambda r: (str(r["activity"]), str(r["handling_route"]), r["median_turnaround_days"])
    assert sorted(map(key, exact)) == sorted(map(key, plain)) or len(exact) == len(plain) == 4
    assert all(r["median_turnaround_days"] is not None for r in exact)
    steps = performance.step_performance(df).count()
    assert performance.bottlenecks(df).count() == performance.wait_shares(df).count() == steps == 2
    assert all(r["touch_p90_days"] is not None for r in performance.wait_shares(df).collect())
    only_null = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None)], "k string, v double")
    assert [tuple(r) for r in exact_quantiles(only_null, ["k"], "v").collect()] == [(None, 2.0)]


def test_runtime_objects_of_state_resources(spark):
    from regulus.operators import inventory as inv
    rows = [("urn:1", "keycloak_openid_client", {"client_id": "web"}), ("urn:2", "kubernetes_config_map", {"metadata": '[{"name":"cm"}]'}),
            ("urn:3", "aws_s3_bucket", {"bucket": "b1", "name": "b2"}), ("urn:4", "local_file", {"filename": "/x/y/z.json"}),
            ("urn:5", "local_file", {}), ("urn:6", "random_thing", {"name": "n"}), ("urn:7", "keycloak_role", {"name": ""})]
    got = inv.managed_edges(spark.createDataFrame(rows, "urn string, type string, attributes map<string,string>")).collect()
    assert sorted((r["src"], r["target"].split(":", 2)[2], r["rule"]) for r in got) == [
        ("urn:1", "keycloak:client:internal/web", "declared"), ("urn:2", "kubernetes:config_map:default/cm", "declared"),
        ("urn:3", "minio:bucket:default/b1", "declared"), ("urn:4", "file:config:generated/z.json", "declared-filename")]


def test_tenant_contract(spark):
    from regulus.operators.marts import tenant_contract
    named = spark.createDataFrame([("a", 1), (None, 2)], "tenant_id string, v int")
    got = tenant_contract({"named": named, "unnamed": spark.range(3), "empty": named.limit(0)}).collect()
    assert sorted(map(tuple, got)) == [("empty", True, 0, 0), ("named", True, 2, 1), ("unnamed", False, 3, 3)]
