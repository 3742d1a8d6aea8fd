"""Question-led answers over the indicator points, bottlenecks and volumes."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regulus.functions.columns import (
    lower_is_better, percent, quarter_index, rounded, with_default,
)
from regulus.operators.kpi import indicator_scores, with_status


def status_counts(points: DataFrame, quarter: str) -> DataFrame:
    """Indicators per traffic light and process, with shares and a headline class."""
    rows = with_status(points.filter(F.col("reporting_quarter") == quarter))
    names = ("success", "warning", "error", "unknown")
    counts = rows.groupBy("process_code").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in names],
        F.count(F.lit(1)).alias("total"))
    ok, warn, bad = (percent(n, "total") for n in names[:3])
    headline = (F.when(bad >= 50, "critical").when(warn >= 50, "elevated risk")
                .when(ok >= 70, "strong").when(ok >= 50, "moderate")
                .when((bad > warn) & (bad > ok), "mixed trending negative").otherwise("mixed"))
    return counts.select("process_code", *names, "total", rounded(ok, 1).alias("pct_success"),
                         rounded(warn, 1).alias("pct_warning"), rounded(bad, 1).alias("pct_error"),
                         headline.alias("headline"))


def targets_answer(points: DataFrame, quarter: str) -> DataFrame:
    """Are we meeting our targets: met, total, missed and the worst gap."""
    scored = indicator_scores(points).filter((F.col("quarter") == quarter)
                                             & F.col("met").isNotNull())
    missed = F.when(~F.col("met"), F.struct("shortfall", "kpi_id", "process"))
    return (scored.groupBy("quarter").agg(
        F.count_if("met").alias("met"), F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("met")).alias("missed"), F.max(missed).alias("w"))
        .select("quarter", "met", "total", "missed", F.col("w.process").alias("worst_process"),
                F.col("w.kpi_id").alias("worst_indicator"),
                F.col("w.shortfall").alias("worst_gap")))


def missed_targets(points: DataFrame, quarter: str) -> DataFrame:
    """Indicators below target, largest gap first."""
    return (indicator_scores(points).filter((F.col("quarter") == quarter) & ~F.col("met"))
            .orderBy(F.desc("shortfall"), "process", "kpi_id"))


def trend_between(points: DataFrame, first: str, last: str) -> DataFrame:
    """Change of each indicator between two quarters, with a half-point dead band."""
    def value_at(quarter: str):
        return F.max(F.when(F.col("reporting_quarter") == quarter, F.col("value")))
    both = (points.filter(F.col("reporting_quarter").isin(first, last))
            .groupBy("process_code", "kpi_id")
            .agg(value_at(first).alias("v0"), value_at(last).alias("v1"))
            .na.drop(subset=["v0", "v1"]))
    change = F.col("v1") - F.col("v0")
    better = F.when(lower_is_better("kpi_id"), change < 0).otherwise(change > 0)
    moved = F.abs(rounded(change, 9)) >= 0.5
    return both.select(
        "process_code", "kpi_id", rounded("v0", 1).alias("first_value"),
        rounded("v1", 1).alias("last_value"), rounded(change, 1).alias("change"),
        F.when(moved & better, "Improving").when(moved, "Declining")
        .otherwise("Little change").alias("direction"))


def trend_answer(points: DataFrame, first: str, last: str) -> DataFrame:
    """How many improved and declined, and the biggest decline."""
    rows = trend_between(points, first, last)
    worst = F.max(F.when(F.col("direction") == "Declining",
                         F.struct(F.abs("change").alias("size"), "process_code", "kpi_id")))
    return (rows.agg(F.count_if(F.col("direction") == "Improving").alias("improving"),
                     F.count_if(F.col("direction") == "Declining").alias("declining"),
                     F.count_if(F.col("direction") == "Little change").alias("little_change"),
                     worst.alias("w"))
            .select("improving", "declining", "little_change",
                    F.col("w.process_code").alias("worst_process"),
                    F.col("w.kpi_id").alias("worst_indicator"), F.col("w.size").alias("worst_size")))


def time_lost(bottleneck_rows: DataFrame, quarter: str) -> DataFrame:
    """Working against queueing time per stage of one quarter."""
    touch, wait = with_default("touch_median_days"), with_default("wait_median_days")
    return bottleneck_rows.filter(F.col("quarter") == quarter).select(
        F.col("process_code").alias("process"), F.col("step").alias("stage"),
        rounded(touch, 1).alias("being_worked_on"), rounded(wait, 1).alias("waiting_in_queue"),
        rounded(touch + wait, 1).alias("total_days"))


def time_lost_answer(bottleneck_rows: DataFrame, quarter: str) -> DataFrame:
    rows = time_lost(bottleneck_rows, quarter)
    worst = F.max(F.struct("total_days", "stage", "process"))
    return (rows.agg(F.count(F.lit(1)).alias("stages"), F.sum("total_days").alias("t"),
                     F.sum("waiting_in_queue").alias("w"), worst.alias("x"))
            .select("stages", rounded("t", 1).alias("total_days"),
                    rounded("w", 1).alias("waiting_days"),
                    rounded(percent("w", "t"), 0).alias("waiting_share"),
                    F.col("x.process").alias("slowest_process"),
                    F.col("x.stage").alias("slowest_stage"),
                    F.col("x.total_days").alias("slowest_days")))


def workload(volumes: DataFrame) -> DataFrame:
    """Received, completed, net change and running open work over all processes.

    One row per quarter reaches the window, so its single ordered group stays tiny.
    """
    def total(metric: str):
        return F.sum(F.when(F.col("metric") == metric, F.col("value")).otherwise(0))
    per_quarter = (volumes.filter(F.col("metric").isin(
        "applications_received", "applications_completed"))
        .groupBy("quarter").agg(total("applications_received").alias("received"),
                                total("applications_completed").alias("completed"))
        .withColumn("net", F.col("received") - F.col("completed"))
        .withColumn("_k", F.lit(0)))
    running = (Window.partitionBy("_k").orderBy(quarter_index("quarter"))
               .rowsBetween(Window.unboundedPreceding, 0))
    return (per_quarter.withColumn("open_at_end", F.sum("net").over(running)).drop("_k")
            .withColumn("direction", F.when(F.col("net") > 0, "grew").when(F.col("net") < 0, "shrank")
                        .otherwise("held steady")))


def compare_processes(points: DataFrame, bottleneck_rows: DataFrame, quarter: str) -> DataFrame:
    """Targets met per process beside the mean of its stage medians."""
    scored = indicator_scores(points).filter((F.col("quarter") == quarter)
                                             & F.col("met").isNotNull())
    summary = scored.groupBy("process").agg(
        F.count(F.lit(1)).alias("indicators"), F.count_if("met").alias("met_target"))
    cycle = (bottleneck_rows.filter(F.col("quarter") == quarter)
             .groupBy(F.col("process_code").alias("process"))
             .agg(rounded(F.avg(with_default("cycle_time_median")), 1).alias("median_stage_days")))
    return (summary.join(cycle, "process", "left")
            .withColumn("pct_meeting_target", rounded(percent("met_target", "indicators"), 0)))


def best_and_worst(comparison: DataFrame) -> DataFrame:
    """Process with the highest and the lowest share; ties go to the first name."""
    first_name = F.struct(-F.col("pct_meeting_target"), "process")
    return comparison.agg(
        F.min_by("process", first_name).alias("best_process"),
        F.max("pct_meeting_target").alias("best_pct"),
        F.min_by("process", F.struct("pct_meeting_target", "process")).alias("worst_process"),
        F.min("pct_meeting_target").alias("worst_pct"))


def quarter_deltas(points: DataFrame) -> DataFrame:
    """Change from the previous observation of each indicator, and whether it is good."""
    series = Window.partitionBy("process_code", "kpi_id").orderBy(quarter_index("reporting_quarter"))
    delta = rounded(F.col("value") - F.lag("value").over(series), 6)
    down = lower_is_better("kpi_id")
    rows = points.withColumn("delta", delta)
    d = F.col("delta")
    return rows.select(
        "process_code", "kpi_id", "reporting_quarter", rounded("value").alias("value"), "delta",
        F.when(d > 0, "up").when(d < 0, "down").otherwise("flat").alias("trend"),
        F.when(d.isNull(), None).when(d == 0, "neutral")
        .when(F.when(down, d < 0).otherwise(d > 0), "good").otherwise("bad").alias("judgement"))


def last_points(points: DataFrame, n: int = 6) -> DataFrame:
    """The last n observations of each series."""
    newest = Window.partitionBy("process_code", "kpi_id").orderBy(
        quarter_index("reporting_quarter").desc())
    return points.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


def scaled_history(points: DataFrame, quarter: str) -> DataFrame:
    """Values up to a quarter scaled to 0..1 over their own range."""
    upto = points.filter(quarter_index("reporting_quarter")
                         <= quarter_index(F.lit(quarter)))
    series = Window.partitionBy("process_code", "kpi_id")
    low, high = F.min("value").over(series), F.max("value").over(series)
    span = F.when(high - low == 0, 1.0).otherwise(high - low)
    return upto.select("process_code", "kpi_id", "reporting_quarter",
                       rounded((F.col("value") - low) / span, 6).alias("scaled"))


def trend_with_target(points: DataFrame, children: DataFrame) -> DataFrame:
    """Each base series beside its constant target and baseline, and its child series.

    ``children`` links child to base indicators and has fixed size.
    """
    value = F.col("value")
    own = points.select("process_code", F.col("kpi_id").alias("base_kpi"), "reporting_quarter",
                        F.explode(F.array(
                            F.struct(F.lit("value").alias("series"), value.alias("v")),
                            F.struct(F.lit("target").alias("series"), F.col("target").alias("v")),
                            F.struct(F.lit("baseline").alias("series"),
                                     F.col("baseline").alias("v")))).alias("p"))
    own = own.select("process_code", "base_kpi", "reporting_quarter",
                     F.col("p.series").alias("series"), rounded("p.v").alias("value"))
    kids = points.join(F.broadcast(children), "kpi_id").select(
        "process_code", "base_kpi", "reporting_quarter", F.col("choice").alias("series"),
        rounded("value").alias("value"))
    return own.unionByName(kids)
