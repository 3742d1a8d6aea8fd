"""The dashboard document: one JSON body per (section, process, name), and the way back.

A body holds the quarters of one series in chronological order, so its size is bounded by the
number of quarters. The whole document never exists in one place.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulus.functions.columns import quarter_index, rounded

BODY_SCHEMA = "struct<data: array<struct<quarter: string, measures: map<string, double>>>>"
REQUIRED_SECTIONS = ("quarterlyData", "processStepData", "kpiCounts", "quarterlyVolumes",
                     "inspectionVolumes", "bottleneckData")


def section(name: str, df: DataFrame, series: str, quarter: str, measures: dict[str, str]) -> DataFrame:
    """Long form of one section; missing observations are left out and never read 0."""
    wide = df.select("process_code", F.col(series).alias("name"), F.col(quarter).alias("quarter"),
                     *[F.col(source).cast("double").alias(m) for m, source in measures.items()])
    return (wide.unpivot(["process_code", "name", "quarter"], list(measures), "measure", "value")
            .filter(F.col("value").isNotNull())
            .select(F.lit(name).alias("section"), F.col("process_code").alias("process"), "name",
                    "quarter", "measure", "value"))


def long_sections(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def documents(long: DataFrame) -> DataFrame:
    """One JSON body per series."""
    per_quarter = long.groupBy("section", "process", "name", "quarter").agg(
        F.map_from_entries(F.collect_list(F.struct("measure", rounded("value").alias("v"))))
        .alias("measures"))
    entry = F.struct(quarter_index("quarter").alias("i"), F.col("quarter"),
                     F.to_json("measures").alias("m"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(
        e["quarter"].alias("quarter"), F.from_json(e["m"], "map<string, double>").alias("measures")))
    return per_quarter.groupBy("section", "process", "name").agg(
        F.to_json(F.struct(ordered.alias("data"))).alias("body"))


def flatten(docs: DataFrame) -> DataFrame:
    """Long form of document rows; a body that is not valid JSON fails the read."""
    parsed = docs.withColumn("d", F.from_json("body", BODY_SCHEMA, {"mode": "FAILFAST"}))
    return (parsed.select("section", "process", "name", F.explode("d.data").alias("p"))
            .select("section", "process", "name", F.col("p.quarter").alias("quarter"),
                    F.explode("p.measures").alias("measure", "value")))


def missing_sections(docs: DataFrame, required: tuple[str, ...] = REQUIRED_SECTIONS) -> list[str]:
    """Required sections a document lacks. The section names are a handful of distinct values."""
    present = {r["section"] for r in docs.select("section").distinct().collect()}
    return [s for s in required if s not in present]


def read_documents(spark, path: str) -> DataFrame:
    """Stored documents; every required section must be there."""
    docs = spark.read.schema("section string, process string, name string, body string").json(path)
    missing = missing_sections(docs)
    if missing:
        raise ValueError(f"document lacks sections: {', '.join(missing)}")
    return docs
