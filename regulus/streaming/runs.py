"""Folders of streaming runs: named by the query's own id and the batch, and removed by pattern.

A query keeps its id as long as its checkpoint lives. A new checkpoint is a new query with a new id, so its batches can never meet the
folders of an earlier one; a repeated batch finds its own folder and replaces it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.readwriter import DataFrameWriter

#: State of arbitrary stateful operators is kept in this store; it spills to local disk and is checkpointed to the shared folder.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def batch_folder(batch: DataFrame, batch_id: int, run: str | None = None) -> str:
    """The relative folder of a batch; ``run`` is the id of the streaming query that runs it, unless given."""
    run = run or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise ValueError("outside of a streaming query a run needs a name")
    return f"run={run}/batch={batch_id}"


def replacing(df: DataFrame) -> DataFrameWriter:
    """A writer that replaces its whole folder, whatever partitions it had before."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")


def adding(df: DataFrame, last: bool) -> DataFrameWriter:
    """A writer that adds to its folder; only the last of several marks the folder as complete."""
    return df.write.mode("append").option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower())


def _at(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Existing files or folders that a pattern matches."""
    store, path = _at(spark, pattern)
    return [status.getPath().toString() for status in store.globStatus(path) or []]


def bytes_below(spark: SparkSession, paths: list[str]) -> int:
    """The length of all files below some folders."""
    total = 0
    for name in paths:
        store, path = _at(spark, name)
        total += store.getContentSummary(path).getLength()
    return total


def remove(spark: SparkSession, paths: list[str]) -> int:
    """Delete files or folders on whatever file system holds them; returns how many were there."""
    removed = 0
    for name in paths:
        store, path = _at(spark, name)
        removed += bool(store.delete(path, True))
    return removed


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """A small file with some text; readers see it when it is whole."""
    store, path = _at(spark, name)
    trial = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}")
    out = store.create(trial, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    store.rename(trial, path)
