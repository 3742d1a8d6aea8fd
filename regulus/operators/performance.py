"""Volumes, inspections, step times, bottlenecks and backlog.

Facts are reduced to small cells before anything is exploded, so no fact row is copied.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regulus import contract as c
from regulus.functions.columns import (
    at, duration_days, is_disaggregated, label_of_index, percent, quarter_index_of, quarter_label,
    ratio, route_class, rounded, step_status,
)
from regulus.operators.measurements import inline, is_compliant
from regulus.operators.quantiles import exact_quantiles, with_quantiles


def _entry(metric: Column, quarter: str) -> Column:
    """A (metric, quarter) pair, or null when either part is missing."""
    q = F.col(quarter)
    return F.when(metric.isNotNull() & q.isNotNull(),
                  F.struct(metric.alias("metric"), q.alias("quarter")))


def _named(mapping: dict[str, dict[str, object]], key: str, pick=lambda v: v) -> Column:
    result = F.when(F.lit(False), "")
    for process, names in mapping.items():
        for source, metric in names.items():
            if pick(metric) is not None:
                result = result.when((F.col("process_code") == process) & (F.col(key) == source),
                                     pick(metric))
    return result


def _spread(cells: DataFrame, entries: list[Column]) -> DataFrame:
    return (cells.select("process_code", "n", F.explode(F.array_compact(F.array(*entries))).alias("e"))
            .groupBy("process_code", F.col("e.quarter").alias("quarter"),
                     F.col("e.metric").alias("metric")).agg(F.sum("n").alias("value")))


def _cells(df: DataFrame, extra: list) -> DataFrame:
    return df.groupBy("process_code", *extra, quarter_label("received_at").alias("q_in"),
                      quarter_label("completed_at").alias("q_out")).agg(
        F.count(F.lit(1)).alias("n"))


def volume_counts(applications: DataFrame, activities: DataFrame) -> DataFrame:
    """Observed (process, quarter, metric, value) volumes."""
    lit = F.lit
    apps = _spread(
        _cells(applications, ["application_type", F.col("route").contains("reliance").alias("rel")]),
        [_entry(lit("applications_received"), "q_in"),
         _entry(lit("applications_completed"), "q_out"),
         _entry(_named(c.TYPE_VOLUMES, "application_type"), "q_in"),
         _entry(F.when((F.col("process_code") == "MA") & F.col("rel"), "reliance_used_count"),
                "q_in")])
    inspected = (F.col("activity_type") == "inspection") & (F.col("process_code") != "CT")
    by_route = _named({p: c.GMP_ROUTE_VOLUMES for p in c.PROCESSES}, "route_class")
    acts = _spread(
        _cells(activities, ["activity_type", route_class("route").alias("route_class"),
                            is_compliant().alias("ok")]),
        [_entry(_named(c.ACTIVITY_VOLUMES, "activity_type", lambda v: v[0]), "q_in"),
         _entry(_named(c.ACTIVITY_VOLUMES, "activity_type", lambda v: v[1]), "q_out"),
         _entry(F.when(inspected, F.when(F.col("ok"), "compliant_facilities")
                       .otherwise("non_compliant_facilities")), "q_out"),
         _entry(F.when(inspected, by_route), "q_out")])
    return apps.unionByName(acts)


def volume_metrics() -> list[tuple[str, str]]:
    """Every (process, metric) the volume section lists."""
    result = []
    for process in c.PROCESSES:
        names = ["applications_received", "applications_completed",
                 *c.TYPE_VOLUMES.get(process, {}).values()]
        names += [m for pair in c.ACTIVITY_VOLUMES[process].values() for m in pair if m]
        if process == "MA":
            names.append("reliance_used_count")
        if process == "GMP":
            names += ["compliant_facilities", "non_compliant_facilities",
                      *c.GMP_ROUTE_VOLUMES.values()]
        result += [(process, n) for n in names]
    return result


def quarterly_volumes(applications: DataFrame, activities: DataFrame) -> DataFrame:
    """Every listed metric of every quarter that has any volume; unobserved ones read 0."""
    counts = volume_counts(applications, activities)
    names = inline(counts.sparkSession, "process_code, metric", volume_metrics())
    quarters = counts.select("process_code", "quarter").distinct()
    return (quarters.join(F.broadcast(names), "process_code")
            .join(counts, ["process_code", "quarter", "metric"], "left")
            .select("process_code", "quarter", "metric",
                    F.coalesce("value", F.lit(0)).cast("long").alias("value")))


def inspection_volumes(activities: DataFrame) -> DataFrame:
    """Requested, conducted and compliant inspections per route class; absent stays absent."""
    cells = _cells(activities.filter(F.col("activity_type") == "inspection"),
                   [route_class("route").alias("route_class"), is_compliant().alias("ok")])
    ct, r = F.col("process_code") == "CT", F.col("route_class")

    def entry(metric: Column, quarter: str, weight: Column) -> Column:
        q = F.col(quarter)
        return F.when(metric.isNotNull() & q.isNotNull(), F.struct(
            metric.alias("metric"), q.alias("quarter"), weight.alias("weight")))

    one, ok = F.lit(1), F.col("ok").cast("int")
    entries = F.array_compact(F.array(
        entry(F.concat(F.lit("requested_"), r), "q_in", one),
        entry(F.concat(F.lit("conducted_"), r), "q_out", one),
        entry(F.concat(F.lit("compliant_"), r), "q_out", ok),
        entry(F.when(ct, "sites_assessed"), "q_out", one),
        entry(F.when(ct, "compliant_sites"), "q_out", ok)))
    return (cells.select("process_code", "n", F.explode(entries).alias("e"))
            .groupBy("process_code", F.col("e.quarter").alias("quarter"),
                     F.col("e.metric").alias("metric"))
            .agg(F.sum(F.col("n") * F.col("e.weight")).alias("value")))


def _finished(steps: DataFrame) -> DataFrame:
    """Steps count once they are finished, whatever their status says."""
    return steps.filter(F.col("completed_at").isNotNull()).select(
        "process_code", F.col("activity_type").alias("step"),
        quarter_label("completed_at").alias("quarter"),
        duration_days("received_at", "completed_at").alias("cycle"),
        duration_days("received_at", "due_at").alias("allowed"), "touch_days", "wait_days")


STEP_KEYS = ["process_code", "step", "quarter"]


def step_performance(steps: DataFrame) -> DataFrame:
    return _finished(steps).groupBy(*STEP_KEYS).agg(
        F.avg("cycle").alias("avg_days"), F.avg("allowed").alias("target_days"))


MEASURES = {"cycle": "cycle_time_median", "touch_days": "touch_median_days", "wait_days": "wait_median_days"}


def _quantiles(rows: DataFrame, named: dict[str, str], p: float) -> DataFrame:
    """One exact quantile per measure and group; every measure is a row of its own for the count."""
    entries = [F.struct(F.lit(n).alias("measure"), F.col(n).alias("days")) for n in named]
    long = (rows.select(*STEP_KEYS, F.explode(F.array(*entries)).alias("e"))
            .select(*STEP_KEYS, "e.measure", "e.days"))
    return (exact_quantiles(long, [*STEP_KEYS, "measure"], "days", p, out="days")
            .groupBy(*STEP_KEYS).pivot("measure", list(named)).agg(F.first("days"))
            .select(*STEP_KEYS, *[F.col(n).alias(out) for n, out in named.items()]))


def bottlenecks(steps: DataFrame, p: float = 0.5) -> DataFrame:
    """Exact cycle, touch and wait quantiles per step and quarter, in one pass."""
    return _quantiles(_finished(steps), MEASURES, p)


def wait_shares(steps: DataFrame) -> DataFrame:
    """Queueing share of elapsed time with the 90th percentiles of both parts."""
    rows = _finished(steps)
    share = rows.groupBy(*STEP_KEYS).agg(
        percent(F.sum("wait_days"), F.sum(F.col("touch_days") + F.col("wait_days")))
        .alias("wait_share_pct"))
    tails = _quantiles(rows, {"touch_days": "touch_p90_days", "wait_days": "wait_p90_days"}, 0.9)
    return with_quantiles(share, tails, STEP_KEYS)


def flow(df: DataFrame, keys: list[str]) -> DataFrame:
    """Opening, received, completed and closing work per quarter.

    Every record adds one at its arrival quarter and one at its completion quarter; running sums
    over the quarters give the balances, so no record is joined to the quarters it spans.
    """
    cells = df.groupBy(*keys, quarter_index_of("received_at").alias("_in"),
                       quarter_index_of("completed_at").alias("_out")).agg(
        F.count(F.lit(1)).alias("n"))
    moves = (cells.select(*keys, F.explode(F.array_compact(F.array(
        F.struct(F.col("_in").alias("q"), F.col("n").alias("i"), F.lit(0).cast("long").alias("o")),
        F.when(F.col("_out").isNotNull(), F.struct(
            F.col("_out").alias("q"), F.lit(0).cast("long").alias("i"), F.col("n").alias("o"))),
    ))).alias("m")).groupBy(*keys, F.col("m.q").alias("q"))
        .agg(F.sum("m.i").alias("received"), F.sum("m.o").alias("completed")))
    spine = (moves.groupBy(*keys).agg(F.min("q").alias("a"), F.max("q").alias("b"))
             .select(*keys, F.explode(F.sequence("a", "b")).alias("q")))
    before = Window.partitionBy(*keys).orderBy("q").rowsBetween(Window.unboundedPreceding, -1)
    full = spine.join(moves, [*keys, "q"], "left").na.fill(0, ["received", "completed"])
    opening = F.coalesce(F.sum(F.col("received") - F.col("completed")).over(before), F.lit(0))
    return (full.withColumn("opening", opening)
            .withColumn("closing", F.col("opening") + F.col("received") - F.col("completed")))


def _quarter_end_ms(index: Column) -> Column:
    """First instant after a quarter."""
    month = F.pmod(index, F.lit(4)) * 3 + 1
    start = F.make_date(F.floor(index / 4).cast("int"), month.cast("int"), F.lit(1))
    return F.unix_millis(F.add_months(start, 3).cast("timestamp"))


def backlog(df: DataFrame, keys: list[str]) -> DataFrame:
    """Opening backlog, carry-over rate, closing backlog and age bands at quarter end.

    An open record is at most 90 days old at no more than two quarter ends, so the three young
    bands come from at most two rows per record and the old band is what remains of the closing
    backlog.
    """
    balances = flow(df, keys)
    q = quarter_index_of("received_at")
    ends = (df.select(*keys, "received_at", "completed_at",
                      F.explode(F.array(q, q + 1)).alias("q"))
            .withColumn("_end", _quarter_end_ms(F.col("q")))
            .filter(F.col("completed_at").isNull() | (F.col("completed_at") >= F.col("_end"))))
    age = F.floor((F.col("_end") - F.col("received_at")) / c.DAY_MS)
    bands = (ends.withColumn("age", age).filter(F.col("age") <= 90).groupBy(*keys, "q").agg(
        F.count_if(F.col("age") <= 30).alias("age_0_30"),
        F.count_if((F.col("age") > 30) & (F.col("age") <= 60)).alias("age_31_60"),
        F.count_if(F.col("age") > 60).alias("age_61_90")))
    young = ["age_0_30", "age_31_60", "age_61_90"]
    joined = balances.join(bands, [*keys, "q"], "left").na.fill(0, young)
    return joined.select(
        *keys, label_of_index("q").alias("quarter"), F.col("opening").alias("opening_backlog"),
        "received", "completed",
        rounded(percent("closing", F.col("opening") + F.col("received")), 6).alias("carry_over_rate"),
        F.col("closing").alias("closing_backlog"), *young,
        (F.col("closing") - reduce(lambda a, b: a + b, [F.col(y) for y in young]))
        .alias("age_90_plus"))


def step_counts(steps: DataFrame) -> DataFrame:
    """Started, completed and still open per step and quarter."""
    rows = steps.withColumnRenamed("activity_type", "step")
    return flow(rows, ["process_code", "step"]).select(
        "process_code", "step", label_of_index("q").alias("quarter"),
        F.col("received").alias("started_q"), F.col("completed").alias("completed_q"),
        F.col("closing").alias("open_end_q"))


def step_table(performance: DataFrame, quarter: str) -> DataFrame:
    """The steps of one quarter that have both values, with their status."""
    return (performance.filter(F.col("quarter") == quarter)
            .na.drop(subset=["avg_days", "target_days"])
            .select("process_code", "step", "avg_days", "target_days",
                    step_status("avg_days", "target_days").alias("status")))


def step_status_counts(performance: DataFrame, quarter: str) -> DataFrame:
    """Steps per status, general steps only."""
    rows = step_table(performance, quarter).filter(~is_disaggregated("step"))
    return rows.groupBy("process_code").agg(*[
        F.count_if(F.col("status") == s).alias(s) for s in ("success", "warning", "error")])


def steps_for_choice(performance: DataFrame, suffix: str | None) -> DataFrame:
    """Steps of one disaggregation, falling back to the general ones per process and quarter.

    Without a suffix only the general steps remain.
    """
    general = ~is_disaggregated("step")
    if suffix is None:
        return performance.filter(general)
    chosen = F.col("step").endswith(suffix)
    present = F.max(chosen).over(Window.partitionBy("process_code", "quarter"))
    return (performance.withColumn("_any", present)
            .filter(F.when(F.col("_any"), chosen).otherwise(general)).drop("_any"))


def relevant_steps(performance: DataFrame, allow: DataFrame) -> DataFrame:
    """The steps that explain an indicator, where both values exist. ``allow`` has fixed size."""
    return (performance.na.drop(subset=["avg_days", "target_days"])
            .join(F.broadcast(allow), ["process_code", "step"]))


def step_time(external: Column, scheduling: Column, touch: Column, wait: Column) -> Column:
    """External wait, else scheduling wait, else touch plus wait when positive."""
    total = F.coalesce(touch, F.lit(0.0)) + F.coalesce(wait, F.lit(0.0))
    return F.coalesce(external, scheduling, F.when(total > 0, total))


def combined_route(volumes: DataFrame, kind: str) -> DataFrame:
    """Reliance plus desk volume of a quarter, either one missing reads 0."""
    def value(route: str):
        return F.coalesce(F.max(F.when(F.col("metric") == f"{kind}_{route}", F.col("value"))),
                          F.lit(0))
    return volumes.groupBy("process_code", "quarter").agg(
        (value("reliance") + value("desk")).cast("long").alias(f"{kind}_reliance_desk"))


def year_split(counts: DataFrame, year: int) -> DataFrame:
    """Observed share counts of every indicator over the quarters of one year, in long form."""
    rows = counts.filter(F.col("reporting_quarter").endswith(f" {year}")
                         & F.col("numerator").isNotNull())
    return (rows.withColumn("meeting", F.col("numerator"))
            .withColumn("not_meeting", F.col("denominator") - F.col("numerator"))
            .unpivot(["process_code", "kpi_id", "reporting_quarter"], ["meeting", "not_meeting"],
                     "series", "value"))


def received_on(applications: DataFrame, calendar: DataFrame) -> DataFrame:
    """Arrivals and completions per calendar day; days without any read 0."""
    def per_day(ms: str, name: str) -> DataFrame:
        return (applications.filter(F.col(ms).isNotNull())
                .groupBy(F.to_date(at(ms)).alias("date_day")).agg(F.count(F.lit(1)).alias(name)))
    return (calendar.join(per_day("received_at", "received"), "date_day", "left")
            .join(per_day("completed_at", "completed"), "date_day", "left")
            .na.fill(0, ["received", "completed"]))


def weighted_wait(steps: DataFrame) -> DataFrame:
    """Time-weighted queueing share beside the mean of monthly shares."""
    monthly = steps.groupBy("process_code", "activity_type", "cohort_month").agg(
        F.sum("wait_days").alias("w"), F.sum(F.col("touch_days") + F.col("wait_days")).alias("e"))
    return monthly.groupBy("process_code", F.col("activity_type").alias("step")).agg(
        ratio(F.sum("w"), F.sum("e"), 100.0).alias("weighted_pct"),
        F.avg(ratio("w", "e", 100.0)).alias("unweighted_pct"))
