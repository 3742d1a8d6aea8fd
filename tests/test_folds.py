"""When folds happen and what they move: first deltas, growing tables, slices of the retraction log."""
from __future__ import annotations

import pytest

from changes import done, envelope, write_batch
from regulus.plans import QUERIES, changes
from regulus.sources import gold
from regulus.streaming import changelog, retractions, runs
from regulus.streaming.medallion import Medallion

MODULE = "regulus.streaming.medallion"


def raw_of(spark, path, offset, *events):
    write_batch(spark, path, "b", list(events), offset)
    return spark.read.schema(changelog.RAW_SCHEMA).json(f"{path}/*")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def state_of(spark, m):
    return [sorted(map(str, df.drop("committed_at").collect())) for df in (m.intervals(spark), m.measurements(spark), m.quarantine(spark), m.silver(spark), m.silver(spark, as_of=1))]


def batches(n):
    """New records, changes of old ones that stay, turn invalid or go, and old changes once more."""
    for k in range(n):
        yield [*[envelope("c", done(f"n{k}-{i}", 1, cohort_month=f"2026-0{1 + i % 3}")) for i in range(6)],
               *[envelope("d" if i == 4 else "u", done(f"n{j}-{i}", k - j + 1, touch_days=-1.0 if i == 2 else 1.0, cohort_month=f"2026-0{1 + i % 3}"))
                 for j in range(k) for i in (1, 2, 4)],
               envelope("u", done("n0-1", 1, cohort_month="2026-02"))]


def fed(spark, path, n):
    m = Medallion(str(path / "lake"))
    for k, events in enumerate(batches(n)):
        m.apply(raw_of(spark, str(path / f"b{k}"), 100 * k, *events), k, "r")
    return m


def test_a_first_delta_waits_for_a_second(spark, tmp_path, monkeypatch):
    """It has one state a key: nothing is folded, and a read does not rank it. The fold with the second bounds its states."""
    usual = fed(spark, tmp_path / "usual", 2)
    want = state_of(spark, usual)
    usual.fold(spark)
    assert state_of(spark, usual) == want
    monkeypatch.setattr(f"{MODULE}.DELTA_BYTES", 1)
    m = fed(spark, tmp_path / "one", 1)
    assert list(m.stored(spark).deltas) == [1] and not m.stored(spark).base
    assert "Window" not in plan_of(m.silver(spark)) and "Exchange" not in plan_of(m.silver(spark)) and m.silver(spark).count() == 6
    m = fed(spark, tmp_path / "two", 2)
    assert not m.stored(spark).deltas and state_of(spark, m) == want


def test_folds_of_a_growing_table_wait_until_deltas_outweigh_the_base(spark, tmp_path, monkeypatch):
    want = state_of(spark, fed(spark, tmp_path / "usual", 6))
    folds, fold = [], Medallion.fold
    monkeypatch.setattr(Medallion, "fold", lambda self, *args: folds.append(self.stored(spark).commit) or fold(self, *args))
    monkeypatch.setattr(f"{MODULE}.DELTA_BYTES", 1)
    monkeypatch.setattr(f"{MODULE}.SLICE_BYTES", 1)
    m = fed(spark, tmp_path / "growing", 6)
    assert folds[0] == 2 and len(folds) < 5  # not with every batch
    assert state_of(spark, m) == want
    m.tidy(spark)
    assert not m.stored(spark).deltas and state_of(spark, m) == want


@pytest.mark.parametrize("bound", [1, 1 << 30])
def test_events_are_made_slice_by_slice(spark, tmp_path, monkeypatch, bound):
    """A slice's keys are sent to the stored states, which do not move, and the events are the same; a batch written again replaces all slices."""
    monkeypatch.setattr(f"{MODULE}.SLICE_BYTES", bound)
    written, adding = [], retractions.adding
    monkeypatch.setattr(retractions, "adding", lambda df, last: (written.append(last), adding(df, last))[1])
    root, m = str(tmp_path / "log"), Medallion(str(tmp_path / "lake"))
    for k, events in enumerate(batches(4)):
        raw = raw_of(spark, str(tmp_path / f"b{k}"), 100 * k, *events)
        m.apply(raw, k, "r")
        for again in range(1 + k % 2):
            retractions.append(raw, root, k, "r")
    assert len(written) == (18 if bound == 1 else 6) and sum(written) == 6
    for name, rows in (("silver", m.silver(spark)), ("quarantine", m.quarantine(spark))):
        assert sorted(map(str, retractions.table(spark, root, name).collect())) == sorted(map(str, rows.collect()))
    assert sorted(map(str, retractions.measured(spark, root).collect())) == sorted(map(str, m.measurements(spark).collect()))
    states = retractions.states_of(root)
    months = states.slices_of(spark, 4)[0]
    entered, left = states.replaced(spark, 4, months)
    assert {r["cohort_month"] for r in entered.select("cohort_month").union(left.select("cohort_month")).collect()} <= months
    for df in (entered, left):
        assert "SortMergeJoin" not in plan_of(df)


def test_the_deliveries_write_the_history_alone(spark, sf_dir, tmp_path, monkeypatch):
    """Of the current activities only the groups that the last delivery changes are made; the rows are those of the gold table."""
    fresh, names, stored = f"{sf_dir}/", [], gold.stored
    gold.forget(spark, fresh)
    monkeypatch.setattr(gold, "stored", lambda s, d, name, *args, **kw: (names.append(name), stored(s, d, name, *args, **kw))[1])
    changes._deliver(spark, fresh, str(tmp_path / "log"))
    assert names == ["history"] and gold.kept(spark, fresh) == set()
    current = gold.activities(spark, fresh)
    last = changes.envelopes(current.filter(changes._group() == changes.DELETED), "d", 500_000_000_000).unionByName(changes.envelopes(changes.corrections(current), "u", 0))
    read = spark.read.schema(changelog.RAW_SCHEMA).json(f"{tmp_path}/log/delivery=2")
    assert sorted(r["payload"] for r in read.collect()) == sorted(r["payload"] for r in last.collect())
    assert runs.folders(spark, f"{tmp_path}/log/delivery=2/_SUCCESS")
    gold.forget(spark, fresh)


def test_many_newer_changes_meet_the_stored_states_once(spark, tmp_path, monkeypatch):
    """By key and order alone; the rows in full then meet only the keys that were found newer, whether those are sent or not."""
    want = state_of(spark, fed(spark, tmp_path / "usual", 4))
    monkeypatch.setattr(f"{MODULE}.SLICE_BYTES", 1)
    monkeypatch.setattr(f"{MODULE}.SENT_KEYS", 0)
    m, met, newest = Medallion(str(tmp_path / "lake")), [], Medallion._newest
    monkeypatch.setattr(Medallion, "_newest", lambda self, spark, at, rows, months: (met.append("entity_id" in rows.columns), newest(self, spark, at, rows, months))[1])
    for k, events in enumerate(batches(4)):
        m.apply(raw_of(spark, str(tmp_path / f"b{k}"), 100 * k, *events), k, "r")
        if k == 0:
            m.fold(spark)
            met.clear()
    assert met == [False] * 9 and state_of(spark, m) == want


def test_a_log_of_one_batch_is_compacted_too(spark, sf_dir, tmp_path, monkeypatch):
    """However many files the log has, the query's rows are those of one file for each month and kind; an empty base has no files."""
    assert Medallion(str(tmp_path / "none")).base_files(spark).collect() == []
    want = sorted(map(tuple, QUERIES["k11_compacted_tables"](spark, sf_dir).collect()))
    root = changes.delivered(spark, sf_dir)
    spark.read.schema(changelog.RAW_SCHEMA).json(f"{root}/log/*").coalesce(1).write.json(f"{tmp_path}/log/delivery=0")
    monkeypatch.setattr(changes, "delivered", lambda *args: str(tmp_path))
    assert sorted(map(tuple, QUERIES["k11_compacted_tables"](spark, sf_dir).collect())) == want and {r[3] for r in want} == {1}
