"""Self-service analysis over the long pool of dashboard values."""
from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regulus.contract import BOTTLENECK_METRICS
from regulus.functions.columns import base_step, last_token, quarter_index, ratio, rounded
from regulus.functions.stats import correlation_p_value

POOL = ("source", "process", "quarter", "year", "metric_name", "category", "value")


def _year(quarter: str = "quarter") -> Column:
    return F.substring(quarter, 4, 4).cast("int")


# ---- flattening ---------------------------------------------------------------------------------
def flatten_volumes(volumes: DataFrame, inspections: DataFrame) -> DataFrame:
    """Volumes of MA and CT and inspection volumes of GMP; the category is the last name part."""
    rows = volumes.filter(F.col("process_code").isin("MA", "CT")).unionByName(
        inspections.filter(F.col("process_code") == "GMP"))
    return rows.select(F.lit("volumes").alias("source"), F.col("process_code").alias("process"),
                       "quarter", _year().alias("year"), F.col("metric").alias("metric_name"),
                       last_token("metric").alias("category"),
                       F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))


def flatten_steps(performance: DataFrame) -> DataFrame:
    return (performance.select(
        "process_code", "step", "quarter", F.col("avg_days").alias("step_avg_days"),
        F.col("target_days").alias("step_target_days"))
        .unpivot(["process_code", "step", "quarter"], ["step_avg_days", "step_target_days"],
                 "metric_name", "value")
        .filter(F.col("value").isNotNull())
        .select(F.lit("steps").alias("source"), F.col("process_code").alias("process"), "quarter",
                _year().alias("year"), "metric_name", base_step("step").alias("category"), "value"))


def flatten_bottlenecks(bottlenecks: DataFrame) -> DataFrame:
    """The published bottleneck metrics that are present; nulls are skipped."""
    present = [m for m in BOTTLENECK_METRICS if m in bottlenecks.columns]
    return (bottlenecks.select("process_code", "step", "quarter",
                               *[F.col(m).cast("double").alias(m) for m in present])
            .unpivot(["process_code", "step", "quarter"], present, "metric_name", "value")
            .filter(F.col("value").isNotNull())
            .select(F.lit("bottlenecks").alias("source"), F.col("process_code").alias("process"),
                    "quarter", _year().alias("year"), "metric_name",
                    F.col("step").alias("category"), "value"))


def pool(parts: list[DataFrame]) -> DataFrame:
    """One pool of all sections; columns a section lacks read as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---- filters ------------------------------------------------------------------------------------
def in_period(df: DataFrame, column: str = "quarter", quarter: str | None = None,
              quarters: tuple[str, str] | None = None,
              years: tuple[int, int] | None = None) -> DataFrame:
    """A single quarter, an inclusive quarter range or a year range; swapped ends are put right."""
    if quarter:
        return df.filter(F.col(column) == quarter)
    if quarters:
        ends = sorted(quarters, key=lambda q: (int(q[3:]), int(q[1])))
        index = quarter_index(column)
        return df.filter((index >= quarter_index(F.lit(ends[0])))
                         & (index <= quarter_index(F.lit(ends[1]))))
    if years:
        year = _year(column)
        return df.filter((year >= min(years)) & (year <= max(years)))
    return df


# ---- analysis -----------------------------------------------------------------------------------
def pivot(rows: DataFrame, index: str, columns: str, names: list[str], how: str = "sum") -> DataFrame:
    """Index by named columns; cells without a value read 0. The names are given, so no extra
    pass looks for them."""
    aggregate = {"sum": F.sum, "mean": F.avg, "median": F.median}[how]
    wide = rows.groupBy(index).pivot(columns, names).agg(aggregate("value"))
    return wide.na.fill(0.0, names)


def percent_change(wide: DataFrame, names: list[str]) -> DataFrame:
    """Change against the previous quarter in per cent, one decimal, in chronological order.

    This deviates on purpose from an ordering by label text, which would compare the first quarters
    of two years with each other. Rows with no change at all are dropped.
    """
    ordered = wide.withColumn("_i", quarter_index("quarter")).withColumn("_k", F.lit(0))
    series = Window.partitionBy("_k").orderBy("_i")
    changes = [rounded(ratio(F.col(n) - F.lag(n).over(series), F.lag(n).over(series), 100.0), 1)
               .alias(n) for n in names]
    return ordered.select("quarter", *changes).na.drop("all", subset=names)


def aligned(rows: DataFrame, first: str, second: str, by: str = "quarter", how: str = "sum") -> DataFrame:
    """Two metrics per period, where both exist."""
    aggregate = {"sum": F.sum, "mean": F.avg, "median": F.median}[how]
    return (rows.filter(F.col("metric_name").isin(first, second)).groupBy(by)
            .pivot("metric_name", [first, second]).agg(aggregate("value"))
            .na.drop(subset=[first, second]))


def regression(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares line of y on x with the strength of the correlation in words."""
    out = pairs.agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"),
                    F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
                    F.corr(y, x).alias("r"))
    size = F.abs("r")
    return out.withColumn("strength", F.when(size > 0.7, "Strong").when(size > 0.3, "Moderate")
                          .when(size > 0.1, "Weak").otherwise("None"))


def significance(line: DataFrame) -> DataFrame:
    """The regression row with the two-sided p-value of its slope, and whether it is below 0.05.

    The input is the one row of an aggregate; the Student tail has no built-in expression.
    """
    schema = T.StructType([*line.schema.fields, T.StructField("p_value", T.DoubleType()),
                           T.StructField("significant", T.BooleanType())])

    def add(batches):
        for rows in batches:
            p = [correlation_p_value(r, n) for r, n in zip(rows["r"], rows["n"])]
            yield rows.assign(p_value=p, significant=[v is not None and v < 0.05 for v in p])

    return line.mapInPandas(add, schema)


def correlation_matrix(wide: DataFrame, names: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all from one aggregate."""
    pairs = list(combinations_with_replacement(names, 2))
    wide_row = wide.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"),
                        F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def shares_within(rows: DataFrame, group: list[str], value: str = "value") -> DataFrame:
    """Each row's share of its group total, by a window instead of a join back."""
    total = F.sum(value).over(Window.partitionBy(*group))
    return rows.withColumn("total", total).withColumn("pct", ratio(value, "total", 100.0))


def waived_shares(rows: DataFrame) -> DataFrame:
    """Share of waived inspections in all inspections; the total itself reads 100."""
    total = F.max(F.when(F.col("category") == "Total Inspections", F.col("value"))).over(
        Window.partitionBy("quarter"))
    return rows.withColumn("pct", F.when(F.col("category") == "Total Inspections", 100.0)
                           .otherwise(ratio("value", total, 100.0)))
