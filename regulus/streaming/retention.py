"""Physical removal from the raw log: days past retention, and every envelope of an erased entity."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus.contract import RETENTION_DAYS, RETENTION_FLOOR_DAYS
from regulus.streaming.changelog import bronze
from regulus.streaming.medallion import Medallion
from regulus.streaming.runs import folders, remove, replacing


def expired_days(rows: DataFrame, as_of_day: str, layer: str = "bronze") -> DataFrame:
    """The ingestion days past the retention of their layer."""
    keep = max(RETENTION_DAYS[layer], RETENTION_FLOOR_DAYS)
    age = F.datediff(F.to_date(F.lit(as_of_day)), F.to_date("ingest_day"))
    return rows.select("ingest_day").distinct().filter(age > keep)


def expire_bronze(spark: SparkSession, path: str, as_of_day: str) -> int:
    """Drop the raw days past retention; returns how many days went."""
    days = [r["ingest_day"] for r in expired_days(bronze(spark, path), as_of_day).collect()]
    for day in days:
        remove(spark, folders(spark, f"{path}/run=*/batch=*/ingest_day={day}"))
    return len(days)


def erase_raw(spark: SparkSession, path: str, entities: DataFrame) -> int:
    """Rewrite the days of the raw log that hold envelopes of the entities without them; returns how many envelopes went.

    The new copy of a day is complete before the old folders go. A stop in between leaves envelopes twice, which the state does not show,
    and the erasure can be repeated.
    """
    rows = bronze(spark, path)
    entity = F.coalesce(F.get_json_object("payload", "$.after.entity_id"), F.get_json_object("payload", "$.before.entity_id"))
    marked = rows.withColumn("entity_id", entity)
    subjects = entities.select("entity_id").distinct()
    hit = marked.join(subjects, "entity_id", "left_semi").groupBy("ingest_day").agg(F.count(F.lit(1)).alias("n")).collect()
    days = [r["ingest_day"] for r in hit]
    if days:
        old = [f for day in days for f in folders(spark, f"{path}/run=*/batch=*/ingest_day={day}")]
        # a row without an entity cannot be anybody's
        kept = marked.filter(F.col("ingest_day").isin(days)).join(subjects, "entity_id", "left_anti").select(*rows.columns)
        replacing(kept).partitionBy("ingest_day").parquet(f"{path}/run=erase-{uuid.uuid4().hex}/batch=0")
        remove(spark, old)
    return sum(r["n"] for r in hit)


def erase_everywhere(spark: SparkSession, families: list[Medallion], bronze_path: str | None, enrichment_path: str | None,
                     entities: DataFrame) -> DataFrame:
    """Erase entities from all families, the raw log and the enrichment; one report row per place."""
    report = [(m.family, sum(r["rows_removed"] for r in m.erase(spark, entities).collect())) for m in families]
    if bronze_path:
        report.append(("bronze", erase_raw(spark, bronze_path, entities)))
    if enrichment_path:
        rows = spark.read.option("basePath", enrichment_path).parquet(f"{enrichment_path}/run_id=*")
        old = folders(spark, f"{enrichment_path}/run_id=*")
        kept = rows.join(entities.select("entity_id").distinct(), "entity_id", "left_anti").select(*[c for c in rows.columns if c != "run_id"])
        gone = rows.count() - kept.count()
        if gone:
            replacing(kept).parquet(f"{enrichment_path}/run_id=erase-{uuid.uuid4().hex}")
            remove(spark, old)
        report.append(("enrichment", gone))
    return spark.createDataFrame(report, "place string, rows_removed bigint")
