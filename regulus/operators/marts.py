"""The certified marts, tenant scoping and the calendar.

A mart is a function of its source frame. A tenant's mart is the mart of the tenant's rows, so the
tenant filter always sits below the aggregation and reaches the scan.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus.functions.columns import month_start, percent, rounded, whole_days
from regulus.operators.measurements import completed
from regulus.operators.quantiles import exact_quantiles, with_quantiles


def for_tenant(source: DataFrame, tenant: str) -> DataFrame:
    if "tenant_id" not in source.columns:
        raise ValueError("a tenant mart needs a source with tenant_id")
    return source.filter(F.col("tenant_id") == tenant)


def tenant_contract(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per source: whether it names a tenant at all, its rows, and those without a tenant."""
    parts = []
    for name, source in sources.items():
        named = "tenant_id" in source.columns
        missing = F.count_if(F.col("tenant_id").isNull()) if named else F.count(F.lit(1))
        parts.append(source.agg(F.lit(name).alias("source"), F.lit(named).alias("has_tenant"),
                                F.count(F.lit(1)).alias("row_count"), missing.alias("without_tenant")))
    return reduce(DataFrame.unionByName, parts)


def _month():
    return [F.col("cohort_month").alias("arrival_month"),
            month_start("cohort_month").alias("arrival_date")]


def _group(df: DataFrame, named: dict[str, str]) -> list:
    return [F.col(source).alias(name) for name, source in named.items()]


def application_throughput(applications: DataFrame, as_of_ms: int) -> DataFrame:
    """Arrivals, completions, open and overdue work. *Now* is a parameter, so runs repeat."""
    done = F.col("status") == "COMPLETED"
    return applications.groupBy(
        F.col("process_code").alias("process"), *_month(), "application_type",
        F.col("route").alias("handling_route")).agg(
        F.count(F.lit(1)).alias("applications_received"),
        F.count_if(done).alias("applications_completed"),
        F.count_if(~done).alias("applications_open"),
        F.count_if(~done & (F.col("due_at") < as_of_ms)).alias("applications_overdue"))


def turnaround_performance(activities: DataFrame, exact_median: bool = False) -> DataFrame:
    """Whole-day turnaround of completed activities.

    The published mart uses an approximate median; ``exact_median`` offers the exact one.
    """
    df = completed(activities).withColumn("days", whole_days("received_at", "completed_at"))
    keys = ["process", "activity", "arrival_month", "arrival_date", "handling_route"]
    df = df.select(F.col("process_code").alias("process"), F.col("activity_type").alias("activity"),
                   *_month(), F.col("route").alias("handling_route"), "days", "touch_days",
                   "wait_days", "completed_at", "due_at")
    aggregates = [
        F.count(F.lit(1)).alias("completed_count"),
        rounded(F.avg("days"), 1).alias("avg_turnaround_days"),
        rounded(F.avg("touch_days"), 1).alias("avg_working_days"),
        rounded(F.avg("wait_days"), 1).alias("avg_waiting_days"),
        rounded(percent(F.count_if(F.col("completed_at") <= F.col("due_at")),
                        F.count(F.lit(1))), 1).alias("pct_on_time")]
    if not exact_median:
        aggregates.append(F.percentile_approx("days", 0.5, 10000).cast("double")
                          .alias("median_turnaround_days"))
        return df.groupBy(*keys).agg(*aggregates)
    return with_quantiles(df.groupBy(*keys).agg(*aggregates),
                          exact_quantiles(df, keys, "days", out="median_turnaround_days"), keys)


def delay_analysis(steps: DataFrame) -> DataFrame:
    """Handling against queueing time per workflow stage."""
    elapsed = F.col("touch_days") + F.col("wait_days")
    return steps.groupBy(
        F.col("process_code").alias("process"), F.col("activity_type").alias("workflow_stage"),
        *_month()).agg(
        F.count(F.lit(1)).alias("times_performed"),
        rounded(F.avg("touch_days"), 1).alias("avg_working_days"),
        rounded(F.avg("wait_days"), 1).alias("avg_waiting_days"),
        rounded(F.avg(elapsed), 1).alias("avg_elapsed_days"),
        rounded(percent(F.sum("wait_days"), F.sum(elapsed)), 1).alias("pct_time_waiting"),
        rounded(percent(F.count_if(F.col("completed_at") <= F.col("due_at")),
                        F.count("completed_at")), 1).alias("pct_stage_on_time"))


def quality_metrics(activities: DataFrame) -> DataFrame:
    """Compliance outcomes; the share is over decided outcomes only."""
    outcome = F.col("outcome")
    return activities.filter(outcome.isNotNull()).groupBy(
        F.col("process_code").alias("process"), F.col("activity_type").alias("activity"),
        *_month(), F.col("route").alias("handling_route")).agg(
        F.count(F.lit(1)).alias("assessments"),
        F.count_if(outcome == "COMPLIANT").alias("compliant_count"),
        F.count_if(outcome == "NON_COMPLIANT").alias("non_compliant_count"),
        rounded(percent(F.count_if(outcome == "COMPLIANT"),
                        F.count_if(outcome.isin("COMPLIANT", "NON_COMPLIANT"))), 1)
        .alias("pct_compliant"))


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(first)), F.to_date(F.lit(last)), F.expr("interval 1 day"))).alias("date_day"))


def bound_violations(throughput: DataFrame, quality: DataFrame, turnaround: DataFrame) -> DataFrame:
    """Mart rows outside their bounds; any row fails a release."""
    c = F.col

    def negative(*names: str):
        return reduce(lambda a, b: a | b, [c(n) < 0 for n in names])

    bad = [
        throughput.filter(negative("applications_received", "applications_completed",
                                   "applications_open", "applications_overdue")
                          | (c("applications_overdue") > c("applications_open"))),
        quality.filter((c("pct_compliant") < 0) | (c("pct_compliant") > 100)
                       | negative("compliant_count", "non_compliant_count")),
        turnaround.filter((c("pct_on_time") < 0) | (c("pct_on_time") > 100)
                          | negative("avg_turnaround_days", "avg_working_days",
                                     "avg_waiting_days"))]
    names = ("application_throughput", "quality_metrics", "turnaround_performance")
    return reduce(DataFrame.unionByName, [
        b.select(F.lit(n).alias("mart"), "process") for n, b in zip(names, bad)])


def publication_check(marts: dict[str, DataFrame]) -> DataFrame:
    """Rows per published product and whether it may be released."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("product"), "rows")
             for name, df in marts.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("published", F.col("rows") > 0)


def publish_views(marts: dict[str, DataFrame]) -> None:
    for name, df in marts.items():
        df.createOrReplaceTempView(name)
