"""The change log to current tables: duplicates, corrections, retractions, deletes, recovery."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changes import DAY, done, envelope, fact, history_events, write_batch
from regulus.contract import FACT_COLUMNS, MEASUREMENT_COLUMNS
from regulus.operators import quality
from regulus.operators.measurements import measurements
from regulus.sources import tables
from regulus.streaming import audit_log, changelog, enrichment, operations, retention, runs
from regulus.streaming.medallion import Medallion, PinLost


def medallion(tmp_path):
    return Medallion(str(tmp_path / "lake"))


def run(spark, m, tmp_path, path):
    q = m.start(changelog.file_source(spark, f"{path}/*"), str(tmp_path / "ckpt"))
    q.awaitTermination()


def ids(df):
    return sorted((r["record_id"], r["revision"]) for r in df.collect())


def same(a, b, columns):
    return quality.multiset_difference(a, b, list(columns)).isEmpty()


def test_bronze_keeps_every_envelope_by_day(spark, tmp_path):
    src = str(tmp_path / "in")
    write_batch(spark, src, "b0", [envelope("c", fact("r1", 1)), envelope("c", fact("r1", 1))], 0)
    for _ in range(2):  # the second start finds nothing new
        changelog.start_bronze(changelog.file_source(spark, f"{src}/*"), str(tmp_path / "bronze"),
                               str(tmp_path / "bck")).awaitTermination()
    bronze = changelog.bronze(spark, str(tmp_path / "bronze"))
    assert bronze.count() == 2
    assert [r["ingest_day"] for r in bronze.select("ingest_day").distinct().collect()] == ["2026-01-02"]
    write_batch(spark, src, "b1", [envelope("c", fact("r2", 1))], 2, day="2026-02-20")
    changelog.start_bronze(changelog.file_source(spark, f"{src}/*"), str(tmp_path / "bronze"),
                           str(tmp_path / "bck")).awaitTermination()
    assert changelog.bronze(spark, str(tmp_path / "bronze")).count() == 3
    assert retention.expire_bronze(spark, str(tmp_path / "bronze"), "2026-01-20") == 0
    assert retention.expire_bronze(spark, str(tmp_path / "bronze"), "2026-03-01") == 1
    left = changelog.bronze(spark, str(tmp_path / "bronze")).collect()
    assert [r["ingest_day"] for r in left] == ["2026-02-20"]


def test_malformed_envelope_fails_the_job(spark):
    raw = spark.createDataFrame([("{not json", 0, 0)], "payload string, partition int, offset bigint")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        changelog.decode(raw).collect()
    raw = spark.createDataFrame([('{"op":"x"}', 0, 0)], "payload string, partition int, offset bigint")
    with pytest.raises(Exception, match="unknown operation"):
        changelog.decode(raw).collect()


def test_life_of_records(spark, tmp_path):
    src, m = str(tmp_path / "in"), medallion(tmp_path)
    n = write_batch(spark, src, "b0", [
        envelope("c", fact("r1", 1)), envelope("u", done("r1", 2)), envelope("u", done("r1", 2)),
        envelope("c", done("r2", 1)), envelope("c", fact("r3", 1, due_at=0))], 0)
    run(spark, m, tmp_path, src)
    assert ids(m.silver(spark)) == [("r1", 2), ("r2", 1)]
    assert ids(m.quarantine(spark)) == [("r3", 1)]
    first = m.last_commit(spark)
    kpis = m.measurements(spark).filter("activity_id = 'r1'")
    assert sorted(r["kpi_id"] for r in kpis.collect()) == [
        "median_duration_continental", "pct_granted_within_90_days"]

    # an older revision is ignored, a correction replaces, validity moves both ways
    n = write_batch(spark, src, "b1", [
        envelope("u", fact("r1", 1)),                       # late duplicate
        envelope("u", done("r1", 3, days=100)),             # correction: another reporting quarter
        envelope("u", done("r2", 2, touch_days=-1.0)),      # valid -> invalid
        envelope("u", done("r3", 2))], n)                   # invalid -> valid
    run(spark, m, tmp_path, src)
    assert ids(m.silver(spark)) == [("r1", 3), ("r3", 2)]
    assert ids(m.quarantine(spark)) == [("r2", 2)]
    quarters = {r["reporting_quarter"] for r in
                m.measurements(spark).filter("activity_id = 'r1'").collect()}
    assert quarters == {"Q2 1970"}
    assert m.measurements(spark).filter("activity_id = 'r2'").count() == 0

    # delete removes the record and its measurements; a replay of old events does not revive it
    n = write_batch(spark, src, "b2", [envelope("d", done("r1", 3, days=100))], n)
    run(spark, m, tmp_path, src)
    n = write_batch(spark, src, "b3", [envelope("c", fact("r1", 1)), envelope("u", done("r1", 2))], n)
    run(spark, m, tmp_path, src)
    assert ids(m.silver(spark)) == [("r3", 2)]
    assert m.measurements(spark).filter("activity_id = 'r1'").count() == 0
    left = m.state(spark).filter("disposition = 'deleted'").select("entity_id").collect()
    assert [r["entity_id"] for r in left] == [None]

    # an earlier version can still be read
    assert ids(m.silver(spark, as_of=first)) == [("r1", 2), ("r2", 1)]


def test_rows_without_key_or_revision_reach_quarantine(spark, tmp_path):
    src, m = str(tmp_path / "in"), medallion(tmp_path)
    write_batch(spark, src, "b0", [
        envelope("c", fact(None, 1)), envelope("c", fact(None, 1)), envelope("c", fact("r1", None)),
        envelope("c", fact("r2", 1, cohort_month=None)), envelope("c", fact("r3", 1, due_at=None))], 0)
    run(spark, m, tmp_path, src)
    assert m.silver(spark).count() == 0
    assert m.quarantine(spark).count() == 5


def test_whole_history_replay_and_late_correction(spark, sf_dir, tmp_path):
    """All revisions in three deliveries give the current table; a full redelivery changes nothing."""
    history = tables.activity_history(spark, sf_dir)
    events = history_events(history)
    src, m = str(tmp_path / "in"), medallion(tmp_path)
    for k, part in enumerate((events.filter("revision = 1"), events.filter("revision = 2"),
                              events.filter("revision > 2"))):
        part.drop("revision").coalesce(2).write.json(f"{src}/b{k}")
        run(spark, m, tmp_path, src)
    expected = tables.activities(spark, sf_dir)
    valid = quality.valid(expected)
    assert same(valid, m.silver(spark), FACT_COLUMNS)
    assert same(quality.quarantine(expected), m.quarantine(spark), FACT_COLUMNS)
    assert same(measurements(valid), m.measurements(spark), MEASUREMENT_COLUMNS)

    events.drop("revision").coalesce(3).write.json(f"{src}/again")
    run(spark, m, tmp_path, src)
    assert same(valid, m.silver(spark), FACT_COLUMNS)
    assert same(measurements(valid), m.measurements(spark), MEASUREMENT_COLUMNS)

    since = m.silver(spark, since="1998-01")
    assert since.count() == valid.filter("cohort_month >= '1998-01'").count()


def raw_of(spark, path, *events, offset=0, day="2026-01-02"):
    write_batch(spark, path, "b", list(events), offset, day)
    return spark.read.schema(changelog.RAW_SCHEMA).json(f"{path}/*")


def test_failed_batch_is_repeated(spark, tmp_path, monkeypatch):
    src, m = str(tmp_path / "in"), medallion(tmp_path)
    n = write_batch(spark, src, "b0", [envelope("c", done("r1", 1))], 0)
    run(spark, m, tmp_path, src)
    write_batch(spark, src, "b1", [envelope("u", done("r1", 2)), envelope("c", done("r2", 1))], n)
    with monkeypatch.context() as broken:
        def fail(*args, **kwargs):
            raise RuntimeError("lost before the write")
        broken.setattr(Medallion, "_write", fail)
        with pytest.raises(Exception, match="lost before the write"):
            run(spark, m, tmp_path, src)
        assert ids(m.silver(spark)) == [("r1", 1)]
    run(spark, m, tmp_path, src)
    assert ids(m.silver(spark)) == [("r1", 2), ("r2", 1)]


def test_new_checkpoint_loses_nothing(spark, tmp_path):
    """Batch numbers begin anew under a new checkpoint; the folders of the old one stay."""
    src, m = str(tmp_path / "in"), medallion(tmp_path)
    n = write_batch(spark, src, "b0", [envelope("c", done("r1", 4)), envelope("c", done("r2", 1))], 0)
    run(spark, m, tmp_path, src)
    other = str(tmp_path / "in2")
    write_batch(spark, other, "b0", [envelope("u", done("r1", 5)), envelope("c", done("r4", 1))], n)
    m.start(changelog.file_source(spark, f"{other}/*"), str(tmp_path / "ckpt2")).awaitTermination()
    assert ids(m.silver(spark)) == [("r1", 5), ("r2", 1), ("r4", 1)]
    # the same for numbered batches of two runs, in either order
    m = Medallion(str(tmp_path / "lake2"))
    m.apply(raw_of(spark, str(tmp_path / "x"), envelope("u", done("r1", 5))), 0, "new")
    m.apply(raw_of(spark, str(tmp_path / "y"), envelope("u", done("r1", 4)), envelope("c", done("r2", 1))), 0, "old")
    assert ids(m.silver(spark)) == [("r1", 5), ("r2", 1)]


def test_repeated_batch_with_other_partitions(spark, tmp_path):
    m = medallion(tmp_path)
    m.apply(raw_of(spark, str(tmp_path / "a"), envelope("c", done("r1", 1)), envelope("c", done("r2", 1, cohort_month="2025-12"))), 0, "r")
    m.apply(raw_of(spark, str(tmp_path / "b"), envelope("c", done("r1", 1)), envelope("c", done("r3", 1, cohort_month="2026-03"))), 0, "r")
    assert ids(m.silver(spark)) == [("r1", 1), ("r3", 1)]
    with pytest.raises(ValueError, match="needs a name"):
        m.apply(raw_of(spark, str(tmp_path / "c"), envelope("c", done("r1", 1))), 0)


def test_bronze_and_audit_keep_the_rows_of_an_old_checkpoint(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for k, events in enumerate(([envelope("c", fact("r1", 1)), envelope("c", fact("r2", 1))], [envelope("c", fact("r3", 1))])):
        src = str(tmp_path / f"in{k}")
        write_batch(spark, src, "b0", events, 10 * k)
        changelog.start_bronze(changelog.file_source(spark, f"{src}/*"), path, str(tmp_path / f"ck{k}")).awaitTermination()
    assert changelog.bronze(spark, path).count() == 3
    for k, name in enumerate("xy"):
        src = str(tmp_path / f"audit{k}")
        spark.createDataFrame([(f'{{"metadata":{{"queryId":"{name}"}},"endTime":"2026-01-0{k + 1}T00:00:00Z"}}',)], "payload string").write.json(src)
        audit_log.start_audit(spark.readStream.schema("payload string").json(src), str(tmp_path / "log"), str(tmp_path / f"ack{k}")).awaitTermination()
    assert sorted(r["query_id"] for r in audit_log.read_audit(spark, str(tmp_path / "log")).collect()) == ["x", "y"]


def months_written(spark, m):
    return {f.split("cohort_month=")[1]: f for f in runs.folders(spark, f"{m.path}/base/upto=*/kept=*/table=valid/cohort_month=*/*.parquet")}


def delivered(spark, tmp_path, m, k, *events):
    m.apply(raw_of(spark, str(tmp_path / f"b{k}"), *events, offset=10 * k), k, "r")


def test_fold_and_pins(spark, tmp_path):
    """Every pin gives the same rows before and after folds, or is refused; no delta folder is left."""
    m = medallion(tmp_path)
    assert m.last_commit(spark) is None and m.silver(spark).isEmpty() and m.fold(spark) == []
    pins = {}
    for k in range(4):
        delivered(spark, tmp_path, m, k, envelope("u", done("r1", k + 1)), envelope("u", done("r2", k + 1, cohort_month="2026-02")),
                  envelope("d" if k else "c", done("r3", k + 1)), envelope("u", done(f"n{k}", 1, touch_days=1.0 - 2 * (k % 2))))
        pins[m.last_commit(spark)] = (ids(m.silver(spark)), ids(m.quarantine(spark)), sorted(map(str, m.measurements(spark).collect())))
        if k == 1:
            assert m.fold(spark) == ["2026-01", "2026-02"]
    assert list(pins) == [1, 2, 3, 4] and pins[1][0] == [("n0", 1), ("r1", 1), ("r2", 1), ("r3", 1)]
    want = sorted(map(str, m.intervals(spark).collect()))

    def check(commits):
        for commit in commits:
            silver, quarantine, kpis = pins[commit]
            assert ids(m.silver(spark, as_of=commit)) == silver and ids(m.quarantine(spark, as_of=commit)) == quarantine
            assert sorted(map(str, m.measurements(spark, as_of=commit).collect())) == kpis
        assert sorted(map(str, m.measurements(spark).collect())) == pins[4][2] and ids(m.silver(spark)) == pins[4][0]
        assert ids(m.silver(spark, since="2026-02")) == [("r2", 4)] and ids(m.silver(spark, since="2026-02", as_of=2)) == [("r2", 2)]

    check(pins)
    m.fold(spark)
    check(pins)
    assert sorted(map(str, m.intervals(spark).collect())) == want and runs.folders(spark, f"{m.path}/delta/commit=*") == []
    for commit in (0, 5):
        with pytest.raises(PinLost):
            m.silver(spark, as_of=commit)
    delivered(spark, tmp_path, m, 4, envelope("u", done("r1", 5)), envelope("u", done("r2", 9, cohort_month="2026-02")))
    m.fold(spark, keep_from=4)
    with pytest.raises(PinLost, match="there are 4 to 5"):
        m.silver(spark, as_of=3)
    assert ids(m.silver(spark, as_of=4)) == pins[4][0] and ids(m.silver(spark, since="2026-02")) == [("r2", 9)]


def test_a_fold_writes_touched_months_only(spark, tmp_path):
    m = medallion(tmp_path)
    delivered(spark, tmp_path, m, 0, *[envelope("c", done(f"r{i}", 1, cohort_month=f"2026-0{1 + i % 3}")) for i in range(9)])
    m.fold(spark)
    before = months_written(spark, m)
    delivered(spark, tmp_path, m, 1, envelope("u", done("r1", 2, cohort_month="2026-02")))
    assert m.compact(spark) == [] and m.compact(spark, commits=0) == ["2026-02"]
    after = months_written(spark, m)
    assert len(before) == 3
    changed = {f for f in after.values()} - {f for f in before.values()}
    assert len(after) == 3 and len(changed) == 1 and "cohort_month=2026-02" in changed.pop()
    assert ids(m.silver(spark)) == [("r0", 1), ("r1", 2), *[(f"r{i}", 1) for i in range(2, 9)]]


def test_a_read_neither_shuffles_nor_ranks_the_base(spark, tmp_path):
    m = medallion(tmp_path)
    delivered(spark, tmp_path, m, 0, *[envelope("c", done(f"r{i}", 1, cohort_month=f"2026-0{1 + i % 3}")) for i in range(9)])
    m.fold(spark)
    assert "Exchange" not in plan_of(m.silver(spark)) and "Exchange" not in plan_of(m.measurements(spark))
    delivered(spark, tmp_path, m, 1, envelope("u", done("r1", 2, cohort_month="2026-02")))
    for df in (m.silver(spark), m.quarantine(spark), m.measurements(spark)):
        old, new = plan_of(df).split("BroadcastExchange")[:2]
        assert "LeftAnti" in old and "Exchange hashpartitioning" not in old and "Window" not in old  # the base's side of the union


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_fold_that_stops_half_way(spark, tmp_path, monkeypatch):
    """Before the generation is complete reads stay with the deltas, after it with the base; the next fold ends it either way."""
    for stop in ("measurements", "remove"):
        m = Medallion(str(tmp_path / stop))
        delivered(spark, tmp_path / stop, m, 0, envelope("c", done("r1", 1)), envelope("c", done("r2", 1)))
        m.fold(spark)
        delivered(spark, tmp_path / stop, m, 1, envelope("u", done("r1", 2)), envelope("d", done("r2", 2)))
        with monkeypatch.context() as broken:
            def fail(*args, **kwargs):
                raise RuntimeError("stopped")
            broken.setattr(f"regulus.streaming.medallion.{stop}", fail)
            with pytest.raises(RuntimeError, match="stopped"):
                m.fold(spark)
        for _ in range(2):
            assert ids(m.silver(spark)) == [("r1", 2)] and ids(m.silver(spark, as_of=1)) == [("r1", 1), ("r2", 1)]
            assert m.measurements(spark).count() == 2 and m.state(spark).count() == 2
            delivered(spark, tmp_path / stop, m, 2, envelope("u", done("r1", 1)))
            m.fold(spark)
        assert runs.folders(spark, f"{m.path}/delta/commit=*") == []


def test_many_deltas_fold_by_themselves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("regulus.streaming.medallion.DELTA_COMMITS", 2)
    m = medallion(tmp_path)
    for k in range(4):
        delivered(spark, tmp_path, m, k, envelope("u", done("r1", k + 1)), envelope("c", done(f"n{k}", 1, cohort_month="")))
        assert len(m.stored(spark).deltas) <= 2
    assert ids(m.silver(spark)) == [*[(f"n{k}", 1) for k in range(4)], ("r1", 4)]
    m.fold(spark)
    delivered(spark, tmp_path, m, 9, envelope("d", done("n1", 2, cohort_month="")))
    assert {r["cohort_month"] for r in m.measurements(spark).filter("activity_id like 'n%'").collect()} == {""}
    assert sorted({r["activity_id"] for r in m.measurements(spark).collect()}) == ["n0", "n2", "n3", "r1"]
    # beyond the bound in bytes deltas are not sent to all tasks, with the same result
    monkeypatch.setattr("regulus.streaming.medallion.DELTA_COMMITS", 64)
    delivered(spark, tmp_path, m, 4, envelope("u", done("r1", 5)))
    monkeypatch.setattr("regulus.streaming.medallion.DELTA_BYTES", 1)
    assert ("r1", 5) in ids(m.silver(spark))
    delivered(spark, tmp_path, m, 5, envelope("u", done("r1", 6)))
    assert m.stored(spark).deltas == {} and ("r1", 6) in ids(m.silver(spark))


def test_erasure_reaches_every_place(spark, tmp_path):
    rows = [envelope("c", done(f"r{i}", 1, entity_id=f"e{i % 3}", cohort_month=f"2026-0{1 + i % 2}")) for i in range(30)]
    rows += [envelope("d", done("r1", 1, entity_id="e1"))]
    raw = raw_of(spark, str(tmp_path / "in"), *rows)
    activities, steps = medallion(tmp_path), Medallion(str(tmp_path / "lake"), "steps")
    activities.apply(raw, 0, "r")
    steps.apply(raw.limit(3), 0, "r")
    path, looked_up = str(tmp_path / "bronze"), str(tmp_path / "enrichment")
    changelog.append_bronze(raw, path, 0, "r")
    enrichment.append(spark.createDataFrame([("e0",), ("e1",)], "entity_id string"), looked_up, "run-1")
    gone = spark.createDataFrame([("e1",), ("nobody",)], "entity_id string")
    report = retention.erase_everywhere(spark, [activities, steps], path, looked_up, gone)
    assert dict(map(tuple, report.collect())) == {"activities": 10, "steps": 1, "bronze": 11, "enrichment": 1}
    assert activities.changes(spark).filter("entity_id = 'e1'").isEmpty() and activities.silver(spark).count() == 20
    assert activities.measurements(spark).count() == 40
    assert changelog.bronze(spark, path).filter("payload like '%\"e1\"%'").isEmpty() and changelog.bronze(spark, path).count() == 20
    again = retention.erase_everywhere(spark, [activities, steps], path, looked_up, gone)
    assert {r["rows_removed"] for r in again.collect()} == {0}
    # entities read from the table itself, while a delta waits
    delivered(spark, tmp_path, activities, 1, envelope("c", done("n1", 1, entity_id="e9")))
    report = activities.erase(spark, activities.silver(spark).filter("entity_id = 'e9'"))
    assert [tuple(r) for r in report.collect()] == [("valid", 1)] and activities.silver(spark).count() == 20


def test_freshness_and_single_writer(spark, tmp_path):
    m = medallion(tmp_path)
    m.apply(raw_of(spark, str(tmp_path / "in"), envelope("c", done("r1", 1))), 0, "r")
    changes = m.changes(spark).withColumn("family", F.lit(m.family))
    last = changes.agg(F.max("committed_at")).first()[0]
    for now, fresh in ((last, True), ("2100-01-01 00:00:00", False)):
        got = operations.freshness(changes, ["family"], F.col("committed_at"), now).collect()
        assert [(r["family"], r["fresh"]) for r in got] == [("activities", fresh)]
    with pytest.raises(RuntimeError, match="expected one running"):
        operations.assert_one_running(spark, "medallion_activities")
    assert DAY == 86_400_000


def test_batches_and_folds_go_through_their_months_in_slices(spark, tmp_path, monkeypatch):
    """The same tables, pins and files with a slice per month; a slice that fails leaves no complete commit."""
    deliveries = [[envelope("c", done(f"r{i}", 1, cohort_month=f"2026-0{1 + i % 4}")) for i in range(12)],
                  [*[envelope("u", done(f"r{i}", 2 - i % 2, touch_days=-1.0 if i > 7 else 1.0, cohort_month=f"2026-0{1 + i % 4}")) for i in range(12)],
                   envelope("d", done("r0", 3, cohort_month="2026-01"))],
                  [envelope("u", done("r5", 7, cohort_month="2026-02"))]]

    def run_all(name):
        m = Medallion(str(tmp_path / name))
        for k, events in enumerate(deliveries):
            delivered(spark, tmp_path / name, m, k, *events)
            if k:
                m.fold(spark)
        return m, [sorted(map(str, df.drop("committed_at").collect())) for df in (
            m.intervals(spark), m.measurements(spark), m.quarantine(spark), m.silver(spark, as_of=1), m.silver(spark))]

    whole, want = run_all("whole")
    moved = []
    monkeypatch.setattr("regulus.streaming.medallion.SLICE_BYTES", 1)
    write = Medallion._write
    monkeypatch.setattr(Medallion, "_write", lambda self, rows, *args: (moved.append({r[0] for r in rows.select("cohort_month").distinct().collect()}), write(self, rows, *args))[1])
    sliced, got = run_all("sliced")
    assert got == want and max(map(len, moved)) == 1 and len(moved) == 9
    assert set(months_written(spark, sliced)) and len(months_written(spark, sliced)) == len(months_written(spark, whole))
    with monkeypatch.context() as broken:
        def fail(self, rows, folder, last):
            if last:
                raise RuntimeError("stopped")
            write(self, rows, folder, last)
        broken.setattr(Medallion, "_write", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            delivered(spark, tmp_path / "broken", sliced, 7, *[envelope("u", done(f"r{i}", 9, cohort_month=f"2026-0{1 + i % 4}")) for i in range(2)])
    assert sorted(map(str, sliced.silver(spark).drop("committed_at").collect())) == want[-1]


def test_a_fold_replaces_its_months_slice_by_slice(spark, tmp_path, monkeypatch):
    """Before a slice begins, the earlier ones have dropped what they replaced; a fold that stops there leaves every read and pin right, and is ended later."""
    monkeypatch.setattr("regulus.streaming.medallion.SLICE_BYTES", 1)
    m, months = medallion(tmp_path), ["2026-01", "2026-02", "", "2026-04"]
    for k in range(2):
        delivered(spark, tmp_path, m, k, *[envelope("u", done(f"r{i}", k + 1, cohort_month=months[i % 4])) for i in range(8)])
        if k == 0:
            m.fold(spark)
    want = [[sorted(map(str, df.collect())) for df in (m.silver(spark, as_of=pin), m.measurements(spark, as_of=pin), m.silver(spark), m.measurements(spark), m.intervals(spark))]
            for pin in (1, 2)]
    sizes, made = [], []
    from regulus.streaming import medallion as module
    facts_of = module.facts_of

    def counted(rows):
        sizes.append(len(runs.folders(spark, f"{m.path}/base/upto=*/kept=*/table=valid/cohort_month=*")))
        if len(sizes) == 3:
            raise RuntimeError("stopped")
        return facts_of(rows)

    with monkeypatch.context() as broken:
        broken.setattr("regulus.streaming.medallion.facts_of", counted)
        with pytest.raises(RuntimeError, match="stopped"):
            m.fold(spark)
    assert sizes == [5, 5, 5]  # four months, and the one that is being written
    at = m.stored(spark)
    assert at.folded == 1 and at.commit == 2 and at.reached == 2 and len(at.delta_months) == 2
    for end in (False, True):
        if end:
            made += m.fold(spark)
        got = [[sorted(map(str, df.collect())) for df in (m.silver(spark, as_of=pin), m.measurements(spark, as_of=pin), m.silver(spark), m.measurements(spark))] for pin in (1, 2)]
        assert got == [w[:4] for w in want]
    assert len(made) == 2 and sorted(map(str, m.intervals(spark).collect())) == want[0][4]
    assert m.stored(spark).folded == 2 and runs.folders(spark, f"{m.path}/delta/commit=*") == []


def test_only_newer_changes_are_kept_in_full(spark, tmp_path, monkeypatch):
    """A batch that repeats what a large base holds is known by key and order; the same rows are stored either way."""
    from regulus.streaming import medallion as module
    staged, stage = [], module._staged
    first = [envelope("c", done(f"r{i}", 1, cohort_month=f"2026-0{1 + i % 3}")) for i in range(9)] + [envelope("c", done(None, 1))]
    later = [*first, envelope("u", done("r1", 2, cohort_month="2026-02")), envelope("u", done("r1", 3, cohort_month="2026-02")), envelope("d", done("r2", 2, cohort_month="2026-03")),
             envelope("u", done("new", None)), envelope("c", done("other", 1))]

    def tables(name, bound, sent):
        monkeypatch.setattr(module, "SLICE_BYTES", bound)
        monkeypatch.setattr(module, "SENT_KEYS", sent)
        m = Medallion(str(tmp_path / name))
        m.apply(raw_of(spark, str(tmp_path / name / "first"), *first), 0, "r")
        m.fold(spark)
        with monkeypatch.context() as seen:
            seen.setattr(module, "_staged", lambda rows, folder: (staged.append((name, folder.rsplit("/", 1)[1], rows.count())), stage(rows, folder)))
            m.apply(raw_of(spark, str(tmp_path / name / "later"), *later), 1, "r")
        return [sorted(map(str, df.drop("committed_at").collect())) for df in (m.changes(spark), m.measurements(spark), m.silver(spark, as_of=1))]

    assert tables("large", 1, 500_000) == tables("small", 1 << 30, 500_000) == tables("many", 1, 0)
    assert staged[:2] == [("large", "order", 15), ("large", "rows", 4)]
    assert staged[2:] == [("small", "rows", 15), ("many", "order", 15), ("many", "rows", 15)]
