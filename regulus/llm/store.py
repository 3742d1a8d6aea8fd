"""Frames written to the shared folder, so that later steps neither recompute them nor depend on one executor."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus.session import removed_at_exit, scratch_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that spark.checkpoint.dir names."""
    return f"{scratch_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage that survives lost executors.

    The copy goes with the session. The collection call lets Spark drop the shuffle files behind the written copy, which nothing needs any more.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    removed_at_exit(spark, path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """A 128-bit key of a row's content. Repeated rows share it, and so share one defined result.

    Each part is led by its length (-1 for null), so neighbouring columns cannot run into each other.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts += [F.coalesce(F.length(text), F.lit(-1)).cast("string"), F.coalesce(text, F.lit(""))]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts).cast("binary")))
