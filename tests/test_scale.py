"""What keeps tables from moving more than they must: shuffles of the lines, pages under the guard, the compressed log."""
from __future__ import annotations

import re
from collections import Counter
from datetime import datetime, timedelta

import pytest

from regulus.plans import QUERIES, changes
from regulus.sources import export, gold, tables
from regulus.streaming.runs import folders, write_text


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def small(spark, tmp_path):
    """Two orders with several states of a line, equal states, a line without number, an earlier one without day and one without order."""
    day = datetime(1997, 1, 1)
    line = "l_orderkey long, l_linenumber int, l_shipdate timestamp, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double," \
           " l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    states = [(k, n, day + timedelta(days=(k * 7 + n * 3 + i // 2) % 5), 1 + i % 3, 1, 1.0 + i % 2, 2.0, 0.1, 0.08, "A", "F")
              for k in (1, 2) for n in (1, 2) for i in range(6)]
    states += [states[0], (1, None, day, 1, 1, 1.0, 1.0, 0.1, 0.0, "R", "O"), (2, 1, None, 1, 1, 1.0, 1.0, 0.1, 0.0, "R", "O"), (None, 1, day, 1, 1, 1.0, 1.0, 0.1, 0.0, "R", "O")]
    order = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    for name, schema, data in (
            ("lineitem", line, states), ("orders", order, [(1, 5, "F", 10.0, day, "1-URGENT"), (2, 5, "O", 10.0, None, "5-LOW")]),
            ("customer", "c_custkey long, c_nationkey int", [(5, 1)]), ("nation", "n_nationkey int, n_regionkey int", [(1, 2)]),
            ("part", "p_partkey long, p_type string, p_size int", [(1, "PROMO", 5), (2, "SMALL", 7), (3, "LARGE", 10)])):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_orders_with_very_many_lines_give_the_same_rows(spark, small, monkeypatch):
    usual = [rows(f(spark, small)) for f in (tables.activities, tables.steps, tables.activity_history)]
    assert [sum(u.values()) for u in usual] == [5, 5, 25]  # a history has no place for a state without number or day
    found = tables.activity_history(spark, small).filter("record_id = '21'").agg({"revision": "min"}).first()
    assert found[0] == 2  # but the state without day is counted
    for hot in (13, 0):  # one of the orders, both of them
        monkeypatch.setattr(tables, "HOT_LINES", hot)
        assert [rows(f(spark, small)) for f in (tables.activities, tables.steps, tables.activity_history)] == usual
    stored = [rows(f(spark, small)) for f in (gold.activities, gold.steps, gold.history)]
    gold.forget(spark, small)
    assert stored == usual


def test_lines_are_shuffled_once_and_not_sorted_before(spark, sf_dir):
    for frame in (tables.current_lines, tables.line_history):
        text = frame(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", text)) == 1
        under = text[re.search(r"Exchange hashpartitioning\(l_orderkey", text).end():].split("Exchange")[0]
        assert "Sort" not in under and "Aggregate" not in under
    gold.activities(spark, sf_dir)
    placed = gold.lines(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in placed and "/cohort_month=" in "".join(gold.lines(spark, sf_dir).inputFiles())


def test_pages_pass_the_guard_and_leave_nothing_out(spark):
    df = spark.range(1000).selectExpr("cast(id as string) AS k", "id")
    pages = export.guarded_pages(df, 150, "k")
    sizes = [p.count() for p in pages]
    assert max(sizes) <= 150 and sum(sizes) == 1000
    assert sorted(r["id"] for p in pages for r in p.collect()) == list(range(1000))
    assert len(export.guarded_pages(df, 1000, "k")) == 1
    with pytest.raises(export.TooManyRows):
        export.guarded_pages(spark.range(20).selectExpr("'one' AS k"), 10, "k")


def test_approximate_medians_are_returned(spark, sf_dir):
    found = QUERIES["a03_approximate_median"](spark, sf_dir)
    assert found.columns == ["process_code", "median_days", "n", "within_bound"]
    assert all(r["median_days"] is not None for r in found.collect())


def test_the_log_is_compressed(spark, sf_dir):
    root = changes.streamed(spark, sf_dir)[0].root.removesuffix("/lake")
    files = folders(spark, f"{root}/log/delivery=*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)


def test_streams_keep_no_gold_table_that_only_they_need(spark, small):
    fresh = small + "/"  # a folder of its own to the registry
    gold.lines(spark, fresh)
    changes._deliver(spark, fresh, f"{small}/log")
    assert gold.kept(spark, fresh) == {"lines"}  # it was there before
    gold.forget(spark, fresh)
    changes._deliver(spark, fresh, f"{small}/log-2")
    assert gold.kept(spark, fresh) == set()
    logs = [rows(spark.read.text([*folders(spark, f"{small}/{log}/delivery={n}")])) for log in ("log", "log-2") for n in range(3)]
    assert logs[:3] == logs[3:] and sum(logs[0].values()) and sum(logs[2].values())


def test_what_reads_the_log_alone_feeds_no_other_tables(spark, small):
    key = (spark.sparkContext.applicationId, small)
    found = changes.retracted(spark, small)
    assert key not in changes._streams and folders(spark, f"{found}/*")
    root = changes.delivered(spark, small)
    assert [f.rsplit("/", 1)[1] for f in folders(spark, f"{root}/*")] == ["log"]
    write_text(spark, f"{root}/checkpoint/x", "")  # a feed that stopped half-way begins anew, with a log of its own
    medallion = changes.streamed(spark, small)[0]
    assert medallion.root == f"{changes.delivered(spark, small)}/lake" != f"{root}/lake"
    assert medallion.state(spark).count() == 5
