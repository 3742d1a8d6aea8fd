"""The raw change log: sources, decoding and the append-only bronze copy."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from regulus.contract import ENVELOPE_SCHEMA, FACT_COLUMNS
from regulus.streaming.runs import batch_folder, replacing

RAW_SCHEMA = "payload string, partition int, offset bigint, ts timestamp"


def file_source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Change envelopes delivered as JSON lines files, from the earliest on."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def topic_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Change envelopes of one topic from the earliest offset; needs the Kafka connector."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    return raw.select(F.col("value").cast("string").alias("payload"), "partition", "offset",
                      F.col("timestamp").alias("ts"))


def decode(raw: DataFrame) -> DataFrame:
    """Typed fact columns with the operation and the position in the log.

    Creates, updates and snapshot reads carry the row in ``after``, deletes in ``before``. A payload
    that is not a valid envelope fails the job: a change must not be lost silently.
    """
    parsed = raw.withColumn("e", F.from_json("payload", ENVELOPE_SCHEMA, {"mode": "FAILFAST"}))
    op = F.col("e.op")
    known = F.when(op.isin("c", "r", "u", "d"), op).otherwise(
        F.raise_error(F.concat(F.lit("unknown operation in envelope: "),
                               F.coalesce(op, F.lit("null")))))
    row = F.when(op == "d", F.col("e.before")).otherwise(F.col("e.after"))
    return (parsed.select(known.alias("op"), row.alias("r"), "partition", "offset")
            .select("op", *[F.col(f"r.{n}").alias(n) for n in FACT_COLUMNS], "partition", "offset"))


def append_bronze(batch: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """The raw envelopes of a batch by ingestion day, in a folder of the batch that a repeated batch replaces."""
    rows = batch.withColumn("ingest_day", F.date_format("ts", "yyyy-MM-dd"))
    replacing(rows).partitionBy("ingest_day").parquet(f"{path}/{batch_folder(batch, batch_id, run)}")


def start_bronze(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The raw, replayable copy, each record exactly once per checkpoint."""
    return (raw.writeStream.queryName("bronze").foreachBatch(lambda batch, batch_id: append_bronze(batch, path, batch_id))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def bronze(spark: SparkSession, path: str) -> DataFrame:
    """The raw copy; days are folders that retention can drop."""
    return (spark.read.schema(f"{RAW_SCHEMA}, ingest_day string").option("basePath", path).parquet(f"{path}/run=*/batch=*")
            .select("payload", "partition", "offset", "ts", "ingest_day"))
