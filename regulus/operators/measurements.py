"""Fan-out of completed activities into indicator measurements."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus import contract as c
from regulus.functions.columns import duration_days, quarter_label


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (tuple, list)):
        return "cast(array(" + ", ".join(_literal(v) for v in value) + ") as array<string>)"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def inline(spark: SparkSession, names: str, rows) -> DataFrame:
    """A small fixed relation as a plan literal, so the optimizer knows its exact size."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def rules(spark: SparkSession) -> DataFrame:
    """The 43 indicator rules. Fixed size, hence safe to broadcast."""
    return inline(
        spark, "process_code, kpi_id, activity_type, aggregation, success, rule_type, routes, "
               "baseline, target",
        [(i.process, i.key, i.activity, i.aggregation, i.success, i.application_type, i.routes,
          i.baseline, i.target) for i in c.indicators()])


def dim_kpi(spark: SparkSession) -> DataFrame:
    return rules(spark).select("process_code", "kpi_id", "aggregation", "baseline", "target")


def matches_rule() -> Column:
    """The part of a rule that is not an equality: any type or this one, any route or these."""
    return (((F.col("rule_type") == "") | (F.col("rule_type") == F.col("application_type")))
            & ((F.size("routes") == 0) | F.array_contains("routes", F.col("route"))))


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("completed_at").isNotNull() & (F.col("status") == "COMPLETED"))


def is_compliant() -> Column:
    return F.coalesce(F.col("outcome") == "COMPLIANT", F.lit(False))


def is_on_time() -> Column:
    return F.col("completed_at") <= F.col("due_at")


def match_rules(activities: DataFrame, rule_table: DataFrame) -> DataFrame:
    """One row per activity and matching rule: one scan and one broadcast hash join on
    (process, activity), with type and route as residual conditions."""
    right = F.broadcast(rule_table.select(
        F.col("process_code").alias("_p"), F.col("activity_type").alias("_a"), "kpi_id",
        "aggregation", "success", "rule_type", "routes"))
    condition = ((F.col("process_code") == F.col("_p")) & (F.col("activity_type") == F.col("_a"))
                 & matches_rule())
    return activities.join(right, condition).drop("_p", "_a", "rule_type", "routes")


def measurements(activities: DataFrame, rule_table: DataFrame | None = None) -> DataFrame:
    """The indicator measurements of valid activities, one row per (activity, indicator)."""
    rule_table = rules(activities.sparkSession) if rule_table is None else rule_table
    ok = F.when(F.col("success") == "compliant", is_compliant()).otherwise(is_on_time())
    value = (F.when(F.col("aggregation") == "percentage", F.when(ok, 100.0).otherwise(0.0))
             .otherwise(duration_days("received_at", "completed_at")))
    return match_rules(completed(activities), rule_table).select(
        F.concat("record_id", F.lit(":"), "kpi_id").alias("measurement_id"), "cohort_month",
        "application_id", F.col("record_id").alias("activity_id"), "tenant_id", "process_code",
        "kpi_id", quarter_label("completed_at").alias("reporting_quarter"),
        value.alias("measured_value"), F.when(ok, 1).otherwise(0).alias("numerator"),
        F.lit(1).alias("denominator"), "updated_at")


def measurements_by_branches(activities: DataFrame) -> DataFrame:
    """The same rows as one UNION ALL branch per rule: the second implementation that the
    join is checked against. It scans its input 43 times, so the join is the one to use."""
    base = completed(activities)
    result = None
    for rule in c.indicators():
        rows = base.filter((F.col("process_code") == rule.process)
                           & (F.col("activity_type") == rule.activity))
        if rule.application_type:
            rows = rows.filter(F.col("application_type") == rule.application_type)
        if rule.routes:
            rows = rows.filter(F.col("route").isin(*rule.routes))
        ok = is_compliant() if rule.success == "compliant" else is_on_time()
        value = (F.when(ok, 100.0).otherwise(0.0) if rule.aggregation == "percentage"
                 else duration_days("received_at", "completed_at"))
        branch = rows.select(
            F.concat("record_id", F.lit(f":{rule.key}")).alias("measurement_id"), "cohort_month",
            "application_id", F.col("record_id").alias("activity_id"), "tenant_id", "process_code",
            F.lit(rule.key).alias("kpi_id"),
            quarter_label("completed_at").alias("reporting_quarter"),
            value.alias("measured_value"), F.when(ok, 1).otherwise(0).alias("numerator"),
            F.lit(1).alias("denominator"), "updated_at")
        result = branch if result is None else result.unionAll(branch)
    return result
