"""Change envelopes built by Spark from the projected history."""
from __future__ import annotations

from pyspark.sql import functions as F

from regulus.contract import FACT_COLUMNS

DAY = 86_400_000


def fact(record, revision, **kw):
    base = dict(record_id=record, application_id="a1", tenant_id="internal", entity_id="e1",
                process_code="MA", application_type="new", activity_type="decision",
                route="on_site_domestic", cohort_month="2026-01", received_at=10 * DAY,
                due_at=40 * DAY, completed_at=None, updated_at=(10 + (revision or 0)) * DAY,
                status="IN_REVIEW", outcome=None, touch_days=1.0, wait_days=2.0, revision=revision)
    base.update(kw)
    return base


def done(record, revision, days=5, **kw):
    return fact(record, revision, **{"status": "COMPLETED", "outcome": "COMPLIANT",
                                     "completed_at": (10 + days) * DAY, **kw})


def envelope(op, row, before=None):
    return {"op": op, "after": None if op == "d" else row, "before": row if op == "d" else before}


def write_batch(spark, path, name, events, offset, day="2026-01-02"):
    """One file of events with consecutive offsets."""
    import json
    rows = [(json.dumps(e), 0, offset + i) for i, e in enumerate(events)]
    df = spark.createDataFrame(rows, "payload string, partition int, offset bigint").withColumn(
        "ts", F.to_timestamp(F.lit(f"{day} 03:04:05")))
    df.coalesce(1).write.mode("append").json(f"{path}/{name}")
    return offset + len(rows)


def history_events(history, op="u"):
    """Every state of a history as an update event, in revision order per key."""
    body = F.struct(F.struct(*FACT_COLUMNS).alias("after"), F.lit(op).alias("op"))
    return history.select(F.to_json(body).alias("payload"), F.lit(0).alias("partition"),
                          (F.col("revision").cast("long") * 1_000_000
                           + F.pmod(F.xxhash64("record_id"), F.lit(1_000_000))).alias("offset"),
                          F.to_timestamp(F.lit("2026-01-02 03:04:05")).alias("ts"), "revision")
