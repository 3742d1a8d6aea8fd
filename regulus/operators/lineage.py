"""Dataset and column lineage from job descriptions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dataset_key(d: Column) -> Column:
    return F.concat(d["namespace"], F.lit("|"), d["name"])


def dataset_edges(jobs: DataFrame) -> DataFrame:
    """Every input to every output of a job: both lists belong to the one job row, so this stays
    within the row and needs no shuffle."""
    return (jobs.select("job", F.explode("inputs").alias("i"), "outputs")
            .select("job", "i", F.explode("outputs").alias("o"))
            .select("job", dataset_key(F.col("i")).alias("source"),
                    dataset_key(F.col("o")).alias("sink")))


def column_edges(jobs: DataFrame) -> DataFrame:
    """Target column with each input field it comes from and how."""
    return (jobs.select("job", F.explode("outputs").alias("o"))
            .select("job", dataset_key(F.col("o")).alias("sink"), F.explode("o.columns").alias("c"))
            .select("job", "sink", F.col("c.name").alias("target_column"),
                    F.col("c.transformation").alias("transformation"),
                    F.explode("c.input_fields").alias("f"))
            .select("job", "sink", "target_column", "transformation",
                    dataset_key(F.col("f")).alias("source"), F.col("f.field").alias("source_column")))


def orphan_datasets(edges: DataFrame, origins: DataFrame) -> DataFrame:
    """Consumed datasets that no job produces and that are not declared origins."""
    return (edges.select(F.col("source").alias("dataset")).distinct()
            .join(edges.select(F.col("sink").alias("dataset")).distinct(), "dataset", "left_anti")
            .join(origins.select("dataset").distinct(), "dataset", "left_anti"))


def missing_edges(declared: DataFrame, present: DataFrame) -> DataFrame:
    """Declared edges that the published graph lacks."""
    keys = ["source", "sink"]
    return declared.select(*keys).distinct().join(present.select(*keys).distinct(), keys, "left_anti")
