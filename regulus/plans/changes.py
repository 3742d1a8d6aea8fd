"""Queries on the streamed tables: envelopes in, silver, quarantine and measurements out."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus.contract import FACT_COLUMNS, MEASUREMENT_COLUMNS
from regulus.functions import columns as x
from regulus.operators import latest
from regulus.plans import oracle as o
from regulus.plans.facts import ROUNDED, neat
from regulus.plans.registry import query
from regulus.session import ONE_WRITE, new_folder, removed_at_exit, settings
from regulus.sources import gold, tables
from regulus.streaming import changelog, operations, retractions
from regulus.streaming.medallion import Medallion
from regulus.streaming.runs import folders

DAY = 86_400_000
REPEAT_EVERY, GROUPS = 7, 50
#: Envelopes in a file of the log. Files are compressed, so a task reads a whole one.
LOG_ROWS = 1_000_000
#: What the last delivery does to the records of every fiftieth application: delete, turn invalid, turn valid, correct late.
DELETED, SPOILT, MENDED, MOVED = 0, 1, 2, 3
_logs: dict[tuple[str, str], str] = {}
_streams: dict[tuple[str, str], tuple[Medallion, int]] = {}
_retractions: dict[tuple[str, str], tuple[str, str]] = {}


def _group():
    return F.col("application_id").cast("long") % GROUPS


def envelopes(history: DataFrame, op: str, shift: int) -> DataFrame:
    """Facts as change envelopes, positioned by revision; a delete carries the row in ``before``."""
    body = F.struct(F.struct(*FACT_COLUMNS).alias("before" if op == "d" else "after"),
                    F.lit(op).alias("op"))
    return history.select(
        F.to_json(body).alias("payload"), F.lit(0).alias("partition"),
        (F.col("revision").cast("long") * 1_000_000_000_000 + F.col("record_id").cast("long")
         + shift).alias("offset"),
        F.timestamp_millis("updated_at").alias("ts"))


def corrections(current: DataFrame) -> DataFrame:
    """One more revision: valid records turn invalid, invalid ones valid, and completions move to a later quarter."""
    changed = current.filter(_group().isin(SPOILT, MENDED, MOVED)).withColumn("revision", F.col("revision") + 1)
    return (changed.withColumn("touch_days", F.when(_group() == SPOILT, -1.0).otherwise(F.col("touch_days")))
            .withColumn("due_at", F.when(_group() == MENDED, F.greatest(F.col("due_at"), F.col("received_at") + 30 * DAY)).otherwise(F.col("due_at")))
            .withColumn("completed_at", F.when(_group() == MOVED, F.col("completed_at") + 200 * DAY).otherwise(F.col("completed_at")))
            .select(*current.columns))


def _deliver(spark: SparkSession, sf_dir: str, log: str) -> None:
    """Write the three deliveries. The history, if only they need it, is dropped as soon as it is written; of the current activities only
    the groups that the last one changes are made."""
    before = gold.kept(spark, sf_dir)
    current = gold.activities(spark, sf_dir) if "activities" in before else tables.activities(spark, sf_dir)
    history = gold.history(spark, sf_dir)
    repeated = history.filter(F.col("record_id").cast("long") % REPEAT_EVERY == 0)
    deliveries = (
        envelopes(history.filter("revision <= 2"), "u", 0),
        envelopes(history.filter("revision > 2"), "u", 0).unionByName(envelopes(repeated, "u", 100_000_000_000)),
        envelopes(current.filter(_group() == DELETED), "d", 500_000_000_000).unionByName(envelopes(corrections(current), "u", 0)))
    for number, events in enumerate(deliveries):
        with settings(spark, ONE_WRITE):
            events.write.option("compression", "gzip").option("maxRecordsPerFile", LOG_ROWS).json(f"{log}/delivery={number}")
        gold.forget(spark, sf_dir, {"history" if number == 1 else ""} - before)


def delivered(spark: SparkSession, sf_dir: str) -> str:
    """The folder with the log of the deliveries, for all that read it. Written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _logs or not folders(spark, f"{_logs[key]}/log/delivery=2/_SUCCESS"):
        root = removed_at_exit(spark, new_folder(spark, "stream"))
        _deliver(spark, sf_dir, f"{root}/log")
        _logs[key] = root
    return _logs[key]


def streamed(spark: SparkSession, sf_dir: str) -> tuple[Medallion, int]:
    """Tables fed by a change log of four deliveries, and the commit of the first. Fed once per application.

    The deliveries are the first two revisions; the later ones with repeated old events; deletes and corrections; and under a
    new checkpoint the whole log once more. The first two are folded into the base, so that reads meet a base and deltas.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _streams and _streams[key][0].last_commit(spark) is not None:
        return _streams[key]
    root = delivered(spark, sf_dir)
    if folders(spark, f"{root}/*checkpoint*"):  # of a feed that stopped half-way: it begins anew
        del _logs[key]
        root = delivered(spark, sf_dir)
    medallion, first, runs = Medallion(f"{root}/lake"), None, []
    log = operations.watch(spark, f"{root}/progress")
    for number, arrived in enumerate(("[0]", "[01]", "[012]")):
        runs.append(medallion.start(changelog.file_source(spark, f"{root}/log/delivery={arrived}"), f"{root}/checkpoint"))
        runs[-1].awaitTermination()
        first = first or medallion.last_commit(spark)
        if number == 1:
            medallion.fold(spark)
    runs.append(medallion.start(changelog.file_source(spark, f"{root}/log/*"), f"{root}/checkpoint-2"))
    runs[-1].awaitTermination()
    medallion.tidy(spark)  # so that the deltas that are left can be sent to all tasks of a read
    operations.recorded(spark, f"{root}/progress", runs)
    spark.streams.removeListener(log)
    _streams[key] = medallion, first
    return _streams[key]


_G = f"CAST(application_id AS BIGINT)%{GROUPS}"
_LAST = ", ".join({
    "revision": f"CAST(CASE WHEN {_G} IN ({SPOILT},{MENDED},{MOVED}) THEN revision+1 ELSE revision END AS INT) AS revision",
    "touch_days": f"CASE WHEN {_G}={SPOILT} THEN -1e0 ELSE touch_days END AS touch_days",
    "due_at": f"CASE WHEN {_G}={MENDED} THEN greatest(due_at, received_at+30*{o.DAY}) ELSE due_at END AS due_at",
    "completed_at": f"CASE WHEN {_G}={MOVED} THEN completed_at+200*{o.DAY} ELSE completed_at END AS completed_at",
}.get(n, n) for n in FACT_COLUMNS)
o.register("h_last", f"SELECT {_LAST} FROM f_activities")
o.register("h_valid", f"SELECT * FROM h_last WHERE {o.VALID} AND {_G}<>{DELETED}")
o.register("h_measurements", o.RELATIONS["f_measurements"].replace("f_valid", "h_valid"))


@query("s02_change_decode", f"SELECT 'u' AS op, {ROUNDED} FROM f_history")
def _(spark, d):
    events = envelopes(gold.history(spark, d), "u", 0)
    rows = changelog.decode(events)
    return neat(rows).withColumn("op", F.lit("u"))


@query("t02_duplicate_normalisation", "SELECT record_id, revision, status, updated_at FROM f_activities")
def _(spark, d):
    """The log delivered twice, reduced to the last state per key."""
    history = gold.history(spark, d).select("record_id", "revision", "status", "updated_at")
    return latest.latest_state(history.unionByName(history), ["record_id"], ["revision"])


@query("k02_streamed_silver", f"SELECT {ROUNDED} FROM h_valid")
def _(spark, d):
    return neat(streamed(spark, d)[0].silver(spark))


@query("k03_streamed_quarantine", f"""SELECT record_id, revision, cohort_month FROM h_last
 WHERE NOT coalesce({o.VALID}, false) AND {_G}<>{DELETED}""")
def _(spark, d):
    return streamed(spark, d)[0].quarantine(spark).select("record_id", "revision", "cohort_month")


@query("k04_streamed_measurements", "SELECT " + ", ".join(
    f"{o.rnd(n)} AS {n}" if n == "measured_value" else n for n in MEASUREMENT_COLUMNS) + " FROM h_measurements")
def _(spark, d):
    return streamed(spark, d)[0].measurements(spark).withColumn(
        "measured_value", x.rounded("measured_value"))


@query("t04_retracted", f"""SELECT record_id, revision, 'quarantine' AS disposition FROM h_last WHERE {_G}={SPOILT}
 UNION ALL SELECT h.record_id, h.revision, 'valid' FROM h_valid h JOIN f_activities a USING (record_id)
 WHERE CAST(h.application_id AS BIGINT)%{GROUPS}={MENDED} AND a.due_at<a.received_at""")
def _(spark, d):
    """Records that a later revision moved through the validity filter, in either direction."""
    medallion, first = streamed(spark, d)
    # as the second delivery left them
    before = medallion.quarantine(spark, as_of=first + 1).filter("due_at < received_at").select("record_id")
    spoilt = medallion.quarantine(spark).filter(_group() == SPOILT)
    mended = medallion.silver(spark).filter(_group() == MENDED).join(before, "record_id", "left_semi")
    return (spoilt.select("record_id", "revision", F.lit("quarantine").alias("disposition"))
            .unionByName(mended.select("record_id", "revision", F.lit("valid").alias("disposition"))))


@query("t05_deleted_keys", f"SELECT record_id AS record_key, revision FROM f_activities WHERE {_G}={DELETED}")
def _(spark, d):
    """What remains of deleted records: the key and its order."""
    gone = streamed(spark, d)[0].state(spark).filter(F.col("disposition") == "deleted")
    return gone.select("record_key", "revision")


@query("t06_late_corrections", f"""SELECT measurement_id, reporting_quarter FROM h_measurements
 WHERE CAST(application_id AS BIGINT)%{GROUPS}={MOVED}""")
def _(spark, d):
    """Corrected measurements stand in their new quarter and nowhere else."""
    return streamed(spark, d)[0].measurements(spark).filter(_group() == MOVED).select("measurement_id", "reporting_quarter")


@query("t09_replay", f"""SELECT 'valid' AS disposition, count(*) AS records FROM h_valid
 UNION ALL SELECT 'quarantine', count(*) FROM h_last WHERE NOT coalesce({o.VALID}, false) AND {_G}<>{DELETED}
 UNION ALL SELECT 'deleted', count(*) FROM h_last WHERE {_G}={DELETED}""")
def _(spark, d):
    """One row per record, although the log came twice under two checkpoints."""
    return streamed(spark, d)[0].state(spark).groupBy("disposition").agg(F.count(F.lit(1)).alias("records"))


_NOW_MS = 915_148_800_000  # 1999-01-01


@query("t12_freshness", f"""SELECT process_code, CAST({_NOW_MS} - max(updated_at) AS DOUBLE)/60000e0 AS age_minutes,
 {_NOW_MS} - max(updated_at) <= 220*{o.DAY} AS fresh FROM h_last WHERE {_G}<>{DELETED} GROUP BY 1""")
def _(spark, d):
    """Age of the newest streamed event of every process against a fixed time."""
    rows = streamed(spark, d)[0].state(spark).filter(F.col("disposition") != "deleted")
    now = F.timestamp_millis(F.lit(_NOW_MS))
    return operations.freshness(rows, ["process_code"], F.timestamp_millis("updated_at"), now, 220 * 1440).select(
        "process_code", "age_minutes", "fresh")


_PINNED = """SELECT record_id, revision FROM (SELECT * FROM f_history WHERE revision<=2
 QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY revision DESC)=1) WHERE """ + o.VALID + " AND cohort_month>='1997-01'"


@query("t12_commit_freshness", f"""SELECT 'medallion_activities' AS name, CAST(4 AS BIGINT) AS commits, CAST(2*count(*) AS BIGINT) AS rows,
 CAST(0 AS BIGINT) AS running, CAST(0 AS BIGINT) AS failed, true AS fresh FROM (SELECT record_id FROM f_history
 UNION ALL SELECT record_id FROM f_history WHERE CAST(record_id AS BIGINT)%{REPEAT_EVERY}=0
 UNION ALL SELECT record_id FROM f_activities WHERE {_G} IN ({DELETED},{SPOILT},{MENDED},{MOVED}))""")
def _(spark, d):
    """What the stored progress tells of the query that fed the tables; it has committed within a day."""
    root = streamed(spark, d)[0].root.removesuffix("/lake")
    return operations.commit_freshness(spark, f"{root}/progress", max_age_minutes=1440).select(
        "name", "commits", "rows", "running", "failed", "fresh")


def retracted(spark: SparkSession, sf_dir: str) -> str:
    """The retraction log of the same deliveries, in several batches. Written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    source = delivered(spark, sf_dir)
    if _retractions.get(key, ("", ""))[0] != source:
        root = removed_at_exit(spark, new_folder(spark, "retractions"))
        retractions.start_retractions(changelog.file_source(spark, f"{source}/log/*", 12), root, f"{root}/checkpoint").awaitTermination()
        _retractions[key] = source, root
    return _retractions[key][1]


@query("t04_retraction_log", f"SELECT {ROUNDED} FROM h_valid")
def _(spark, d):
    """Silver from the log of what entered and what left it."""
    return neat(retractions.table(spark, retracted(spark, d), "silver"))


@query("t02_retraction_quarantine", f"""SELECT record_id, revision, cohort_month FROM h_last
 WHERE NOT coalesce({o.VALID}, false) AND {_G}<>{DELETED}""")
def _(spark, d):
    """Quarantine from the same log."""
    return retractions.table(spark, retracted(spark, d), "quarantine").select("record_id", "revision", "cohort_month")


@query("t07_measurement_events", "SELECT " + ", ".join(
    f"{o.rnd(n)} AS {n}" if n == "measured_value" else n for n in MEASUREMENT_COLUMNS) + " FROM h_measurements")
def _(spark, d):
    """The measurements from the log of those that came and went."""
    return retractions.measured(spark, retracted(spark, d)).withColumn("measured_value", x.rounded("measured_value"))


@query("s03_pinned_snapshot", _PINNED)
def _(spark, d):
    """The tables as the first delivery left them, from one cohort on."""
    medallion, first = streamed(spark, d)
    return medallion.silver(spark, as_of=first, since="1997-01").select("record_id", "revision")


@query("s03_pinned_after_fold", _PINNED)
def _(spark, d):
    """The same pin after everything that waits has been folded into the base."""
    medallion, first = streamed(spark, d)
    medallion.fold(spark)
    return medallion.silver(spark, as_of=first, since="1997-01").select("record_id", "revision")


@query("w12_state_intervals", f"""WITH s AS (
 SELECT record_id, max(revision) AS revision, 1 AS c FROM f_history WHERE revision<=2 GROUP BY 1
 UNION ALL SELECT record_id, max(revision), 2 FROM f_history GROUP BY 1 HAVING max(revision)>2 OR CAST(record_id AS BIGINT)%{REPEAT_EVERY}=0
 UNION ALL SELECT record_id, revision, 3 FROM h_last WHERE {_G} IN ({DELETED},{SPOILT},{MENDED},{MOVED}))
 SELECT record_id AS record_key, CAST(revision AS INT) AS revision, CAST(c AS BIGINT) AS from_commit,
 CAST(lead(c) OVER (PARTITION BY record_id ORDER BY c) AS BIGINT) AS upto_commit FROM s""")
def _(spark, d):
    """Every state that ever was current, with the commits from which and up to which it held."""
    return streamed(spark, d)[0].intervals(spark).select("record_key", "revision", "from_commit", "upto_commit")


@query("k11_compacted_tables", f"""SELECT cohort_month, disposition, count(*) AS records, CAST(1 AS BIGINT) AS files FROM (
 SELECT cohort_month, CASE WHEN {_G}={DELETED} THEN 'deleted' WHEN coalesce({o.VALID}, false) THEN 'valid' ELSE 'quarantine' END AS disposition FROM h_last)
 GROUP BY 1, 2""")
def _(spark, d):
    """Four deliveries in small files, compacted: one file for each month and kind of state."""
    root = removed_at_exit(spark, new_folder(spark, "compacted"))
    source = delivered(spark, d)
    small = Medallion(f"{root}/lake")
    small.start(changelog.file_source(spark, f"{source}/log/*", 8), f"{root}/checkpoint").awaitTermination()
    small.compact(spark, commits=0)  # a small log comes in one batch, which waits as the first delta
    rows = small.base_files(spark).filter(F.col("table") != "past")
    return rows.groupBy("cohort_month", F.col("table").alias("disposition")).agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("file").alias("files"))
