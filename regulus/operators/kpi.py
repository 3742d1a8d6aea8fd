"""Quarterly indicators: from measurements, and independently from the facts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulus.contract import indicators
from regulus.functions.columns import (
    duration_days, light_status, met_target, percent, quarter_label, quarter_start, rounded,
    shortfall, target_status, unit_of,
)
from regulus.operators.measurements import (
    completed, dim_kpi, is_compliant, is_on_time, match_rules, rules,
)
from regulus.operators.quantiles import exact_quantiles


def _median_keys() -> list[str]:
    return [i.key for i in indicators() if i.aggregation == "median"]


def _finish(totals: DataFrame, medians: DataFrame, keys: list[str]) -> DataFrame:
    dim = F.broadcast(dim_kpi(totals.sparkSession))
    value = (F.when(F.col("aggregation") == "percentage", percent("numerator", "denominator"))
             .when(F.col("aggregation") == "average", F.col("_sum") / F.col("_rows"))
             .otherwise(F.col("_median")))
    return (totals.join(dim, ["process_code", "kpi_id"]).join(medians, keys, "left")
            .withColumn("value", value)
            .select(*keys, "baseline", "target", "numerator", "denominator", "updated_at", "value"))


def kpi_quarterly(measurement_rows: DataFrame) -> DataFrame:
    """Indicator value per tenant, process, indicator and quarter against its target.

    Counts and means combine on the map side. Only the rows of median indicators take the exact
    quantile path, and that filter reaches the scan.
    """
    keys = ["tenant_id", "process_code", "kpi_id", "reporting_quarter"]
    totals = measurement_rows.groupBy(*keys).agg(
        F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"),
        F.sum("measured_value").alias("_sum"), F.count(F.lit(1)).alias("_rows"),
        F.max("updated_at").alias("updated_at"))
    medians = exact_quantiles(measurement_rows.filter(F.col("kpi_id").isin(*_median_keys())),
                              keys, "measured_value", out="_median")
    return _finish(totals, medians, keys)


def kpi_from_facts(activities: DataFrame) -> DataFrame:
    """The same indicators without materialising measurements and without a tenant.

    Facts are reduced to cells of (process, activity, type, route, quarter) first, and the rules
    then meet the cells, so the fan-out multiplies thousands of rows and not the facts.
    """
    rule_table = rules(activities.sparkSession)
    days = duration_days("received_at", "completed_at")
    cell = ["process_code", "activity_type", "application_type", "route", "reporting_quarter"]
    keys = ["process_code", "kpi_id", "reporting_quarter"]
    done = completed(activities).withColumn("reporting_quarter", quarter_label("completed_at"))
    cells = done.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(is_on_time()).alias("_on_time"),
        F.count_if(is_compliant()).alias("_compliant"), F.sum(days).alias("_days"),
        F.max("updated_at").alias("_updated"))
    hits = F.when(F.col("success") == "compliant", F.col("_compliant")).otherwise(F.col("_on_time"))
    totals = match_rules(cells, rule_table).groupBy(*keys).agg(
        F.sum(hits).alias("numerator"), F.sum("_n").alias("denominator"),
        F.sum("_days").alias("_sum"), F.sum("_n").alias("_rows"),
        F.max("_updated").alias("updated_at"))
    timed = sorted({i.activity for i in indicators() if i.aggregation == "median"})
    durations = (done.filter(F.col("activity_type").isin(*timed))
                 .groupBy(*cell, days.alias("_duration")).agg(F.count(F.lit(1)).alias("_n")))
    medians = exact_quantiles(
        match_rules(durations, rule_table.filter(F.col("aggregation") == "median")),
        keys, "_duration", weight="_n", out="_median")
    return _finish(totals, medians, keys)


def indicator_performance(kpi: DataFrame) -> DataFrame:
    """Certified view: every indicator point with its quarter start and target status."""
    return kpi.select(
        *[c for c in ("tenant_id",) if c in kpi.columns],
        F.col("process_code").alias("process"), F.col("kpi_id").alias("indicator"),
        F.col("reporting_quarter").alias("quarter"),
        quarter_start("reporting_quarter").alias("quarter_start"),
        F.col("value").alias("indicator_value"), F.col("target").alias("indicator_target"),
        F.col("baseline").alias("indicator_baseline"), "numerator", "denominator",
        target_status("kpi_id", "value", "target").alias("target_status"))


def indicator_scores(points: DataFrame) -> DataFrame:
    """Points with met flag, signed shortfall and unit."""
    return points.filter(F.col("value").isNotNull()).select(
        F.col("process_code").alias("process"), "kpi_id",
        F.col("reporting_quarter").alias("quarter"), rounded("value", 1).alias("value"),
        rounded("target", 1).alias("target"), met_target("kpi_id", "value", "target").alias("met"),
        shortfall("kpi_id", "value", "target").alias("shortfall"), unit_of("kpi_id").alias("unit"))


def with_status(points: DataFrame) -> DataFrame:
    return points.withColumn("status", light_status("kpi_id", "value", "target"))


def kpi_counts(points: DataFrame) -> DataFrame:
    """Counts behind a point: numerator and denominator for shares, sample size otherwise."""
    share = F.col("kpi_id").startswith("pct_")
    return points.select(
        "process_code", "kpi_id", "reporting_quarter",
        F.when(share, F.col("numerator")).alias("numerator"),
        F.when(share, F.col("denominator")).alias("denominator"),
        F.when(~share, F.col("denominator")).alias("sample_n"))


def rates_from_counts(counts: DataFrame) -> DataFrame:
    n, d = F.col("numerator"), F.col("denominator")
    return counts.select(
        "process_code", "kpi_id", "reporting_quarter", n, d,
        F.when(d > 0, rounded(percent(n, d), 1)).otherwise(0.0).alias("value"))
