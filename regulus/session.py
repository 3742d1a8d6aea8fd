"""Session settings and the shared scratch folder."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "regulus", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package relies on; any of them can be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_business_time(spark: SparkSession) -> None:
    """Quarters, months and days are UTC everywhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs of a block; the earlier ones come back behind it."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: For writes whose frame nobody asks for again: their shuffles go with the job, and tasks keep the files of a few months open instead of
#: sorting their rows by month.
ONE_WRITE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "32"}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where none is set, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(local)
    return local


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """Let the file system drop a scratch folder, once it is written, when the session's process ends."""
    store, folder = _file_system(spark, path)
    store.deleteOnExit(folder)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A new, still empty folder below the shared one."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    store, folder = _file_system(spark, path)
    store.mkdirs(folder)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    store, folder = _file_system(spark, path)
    store.delete(folder, True)


class Cuts:
    """Frames written to the shared folder and read back, so a loop does not grow its plan.

    A copy survives the loss of any executor. ``result`` writes what the caller goes on with and drops
    the copies it came from; the session's end drops the rest.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{scratch_dir(self.spark)}/cut-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append(removed_at_exit(self.spark, path))
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, *frames: DataFrame) -> list[DataFrame]:
        old, self.paths = self.paths, []
        kept = [self.cut(df) for df in frames]
        for path in old:
            drop_folder(self.spark, path)
        return kept
