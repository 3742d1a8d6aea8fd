"""The physical plans: pruned scans, broadcast rules, no Cartesian products, no Python in reports."""
from __future__ import annotations

import re

import pytest

from regulus.operators import kpi, measurements as m
from regulus.plans import QUERIES
from regulus.sources import gold

REPORTS = ("a01_kpi_quarterly", "a09_application_throughput", "a10_turnaround_performance",
           "a11_delay_analysis", "a12_quality_metrics", "a14_kpi_from_facts", "a16_quarterly_volumes",
           "a19_bottleneck_medians", "a42_backlog", "j03_rule_join", "j13_alias_priority")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert word not in text


def test_rules_are_broadcast_on_process_and_activity(spark, sf_dir):
    text = plan(m.measurements(gold.valid_activities(spark, sf_dir)))
    assert re.search(r"BroadcastHashJoin \[process_code#\d+, activity_type#\d+\]", text)


def test_delay_analysis_reads_only_its_columns(spark, sf_dir):
    text = plan(QUERIES["a11_delay_analysis"](spark, sf_dir))
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert "wait_days" in columns
    assert "entity_id" not in columns and "received_at" not in columns


def test_filters_reach_the_scan(spark, sf_dir):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(kpi.kpi_quarterly(gold.measurements(spark, sf_dir))))
    assert any("In(kpi_id" in p or "kpi_id" in p for p in pushed)
    text = plan(QUERIES["s03_cohort_scan"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^\]]*cohort_month#\d+ >= 1997-01", text)
    text = plan(QUERIES["p14_tenant_mart"](spark, sf_dir))
    assert "EqualTo(tenant_id,partner_alpha)" in text


def test_quantile_counts_are_shuffled_once(spark, sf_dir):
    df = QUERIES["a19_bottleneck_medians"](spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in plan(df)
