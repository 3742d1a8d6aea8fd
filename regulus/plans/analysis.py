"""Self-service queries over the pool of dashboard values, and usage of the query log."""
from __future__ import annotations

import time

from pyspark.sql import functions as F

from regulus.functions import columns as x
from regulus.operators import audit as audit_ops, selfservice as s
from regulus.operators import kpi as kpi_ops
from regulus.plans import oracle as o
from regulus.plans import reports as r
from regulus.plans.indicators import points
from regulus.plans.registry import query
from regulus.session import new_folder, removed_at_exit
from regulus.sources import gold, tables
from regulus.streaming import audit_log, enrichment

_YEAR = "CAST(substr(quarter,4,4) AS INT)"
_BASE = ("CASE " + " ".join(f"WHEN ends_with(step,'{e}') THEN substr(step,1,length(step)-{len(e)})"
                            for e in r.c.STEP_SUFFIXES) + " ELSE step END")
o.register("p_volumes", f"""SELECT 'volumes' AS source, process_code AS process, quarter, {_YEAR} AS year, metric AS metric_name,
 CASE WHEN contains(metric,'_') THEN split_part(metric,'_',-1) END AS category, CAST(value AS DOUBLE) AS value
 FROM (SELECT * FROM f_volumes WHERE process_code IN ('MA','CT') UNION ALL SELECT * FROM f_inspections WHERE process_code='GMP')""")
o.register("p_steps", f"""SELECT 'steps' AS source, process_code AS process, quarter, {_YEAR} AS year, metric_name, {_BASE} AS category, value
 FROM (SELECT process_code, step, quarter, 'step_avg_days' AS metric_name, avg_days AS value FROM f_step_performance
 UNION ALL SELECT process_code, step, quarter, 'step_target_days', target_days FROM f_step_performance) WHERE value IS NOT NULL""")
o.register("p_bottlenecks", f"""SELECT 'bottlenecks' AS source, process_code AS process, quarter, {_YEAR} AS year,
 'cycle_time_median' AS metric_name, step AS category, cycle_time_median AS value FROM f_bottlenecks""")
o.register("p_pool", "SELECT * FROM p_volumes UNION ALL SELECT * FROM p_steps UNION ALL SELECT * FROM p_bottlenecks")


def volume_pool(spark, d):
    return s.flatten_volumes(r.volumes(spark, d), r.inspections(spark, d))


def neat(df):
    return df.withColumn("value", x.rounded("value"))


def sql_neat(relation):
    return f"SELECT source, process, quarter, year, metric_name, category, {o.rnd('value')} AS value FROM {relation}"


@query("f16_flatten_volumes", sql_neat("p_volumes"))
def _(spark, d):
    return neat(volume_pool(spark, d))


@query("f16_flatten_steps", sql_neat("p_steps"))
def _(spark, d):
    return neat(s.flatten_steps(r.step_points(spark, d)))


@query("u05_analytics_pool", sql_neat("p_pool"))
def _(spark, d):
    return neat(s.pool([volume_pool(spark, d), s.flatten_steps(r.step_points(spark, d)),
                        s.flatten_bottlenecks(r.step_medians(spark, d))]))


@query("f13_metric_category", """SELECT DISTINCT metric_name, category FROM p_volumes""")
def _(spark, d):
    return volume_pool(spark, d).select("metric_name", "category").distinct()


@query("p11_year_range", sql_neat("p_volumes") + " WHERE year BETWEEN 1997 AND 1999")
def _(spark, d):
    return neat(s.in_period(volume_pool(spark, d), years=(1999, 1997)))


_PIVOT = ("applications_received", "applications_completed", "approvals_granted")


def _pivot_sql(how="sum"):
    cells = ", ".join(f"coalesce({how}(CASE WHEN metric_name='{m}' THEN value END),0) AS {m}" for m in _PIVOT)
    return f"SELECT quarter, {cells} FROM p_volumes WHERE metric_name IN {_PIVOT} GROUP BY 1"


def _wide(spark, d, how="sum"):
    rows = volume_pool(spark, d).filter(F.col("metric_name").isin(*_PIVOT))
    return s.pivot(rows, "quarter", "metric_name", list(_PIVOT), how)


@query("a27_pivot", _pivot_sql())
def _(spark, d):
    return _wide(spark, d)


@query("a27_pivot_by_category_median", f"""SELECT year, {o.rnd("coalesce(median(CASE WHEN category='received' THEN value END),0)")} AS received,
 {o.rnd("coalesce(median(CASE WHEN category='completed' THEN value END),0)")} AS completed FROM p_volumes
 WHERE category IN ('received','completed') GROUP BY 1""")
def _(spark, d):
    """Medians of pooled values: the pool has one row per metric and quarter, not per fact."""
    names = ["received", "completed"]
    rows = volume_pool(spark, d).filter(F.col("category").isin(*names))
    return s.pivot(rows, "year", "category", names, "median").select(
        "year", *[x.rounded(n).alias(n) for n in names])


_CHANGE = ", ".join(
    f"{o.rnd(f'100e0*({m}-lag({m}) OVER w)/nullif(lag({m}) OVER w,0)', 1)} AS {m}" for m in _PIVOT)


@query("w02_percent_change", f"""SELECT * FROM (SELECT quarter, {_CHANGE} FROM ({_pivot_sql()})
 WINDOW w AS (ORDER BY {o.qindex('quarter')})) WHERE coalesce({', '.join(_PIVOT)}) IS NOT NULL""")
def _(spark, d):
    return s.percent_change(_wide(spark, d), list(_PIVOT))


_PAIR = """SELECT quarter, sum(CASE WHEN metric_name='applications_received' THEN value END) AS applications_received,
 sum(CASE WHEN metric_name='applications_completed' THEN value END) AS applications_completed FROM p_volumes GROUP BY 1
 HAVING count(CASE WHEN metric_name='applications_received' THEN 1 END)>0
 AND count(CASE WHEN metric_name='applications_completed' THEN 1 END)>0"""


@query("j08_aligned_metrics", _PAIR)
def _(spark, d):
    return s.aligned(volume_pool(spark, d), *_PIVOT[:2])


@query("a28_regression", f"""SELECT n, slope, intercept, r2, r, CASE WHEN abs(r)>0.7 THEN 'Strong' WHEN abs(r)>0.3 THEN 'Moderate'
 WHEN abs(r)>0.1 THEN 'Weak' ELSE 'None' END AS strength FROM (SELECT count(*) AS n,
 {o.rnd('regr_slope(applications_completed,applications_received)')} AS slope,
 {o.rnd('regr_intercept(applications_completed,applications_received)')} AS intercept,
 {o.rnd('regr_r2(applications_completed,applications_received)')} AS r2,
 {o.rnd('corr(applications_completed,applications_received)')} AS r FROM ({_PAIR}))""")
def _(spark, d):
    names = ("slope", "intercept", "r2", "r")
    line = s.regression(s.aligned(volume_pool(spark, d), *_PIVOT[:2]), *_PIVOT[:2])
    return line.select("n", *[x.rounded(n).alias(n) for n in names], "strength")


_MATRIX = " UNION ALL ".join(
    f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, {o.rnd(f'corr({a},{b})')} AS r FROM ({_pivot_sql()})"
    for i, a in enumerate(_PIVOT) for b in _PIVOT[i:])


@query("a29_correlation_matrix", _MATRIX)
def _(spark, d):
    return s.correlation_matrix(_wide(spark, d), list(_PIVOT)).withColumn("r", x.rounded("r"))


@query("w10_category_shares", f"""SELECT process, quarter, metric_name, value, total, {o.rnd('100e0*value/nullif(total,0)')} AS pct
 FROM (SELECT *, sum(value) OVER (PARTITION BY process, quarter, category) AS total FROM p_volumes WHERE category='applications')""")
def _(spark, d):
    rows = volume_pool(spark, d).filter(F.col("category") == "applications")
    return s.shares_within(rows, ["process", "quarter", "category"]).select(
        "process", "quarter", "metric_name", "value", "total", x.rounded("pct").alias("pct"))


@query("j07_pair_shares", f"""SELECT kpi_id, reporting_quarter, series, value, {o.rnd('100e0*value/nullif(total,0)')} AS pct FROM
 (SELECT *, sum(value) OVER (PARTITION BY kpi_id, reporting_quarter) AS total FROM (
 SELECT kpi_id, reporting_quarter, 'meeting' AS series, CAST(numerator AS DOUBLE) AS value FROM f_points WHERE ends_with(reporting_quarter,'1998') AND starts_with(kpi_id,'pct_')
 UNION ALL SELECT kpi_id, reporting_quarter, 'not_meeting', CAST(denominator-numerator AS DOUBLE) FROM f_points WHERE ends_with(reporting_quarter,'1998') AND starts_with(kpi_id,'pct_')))""")
def _(spark, d):
    from regulus.operators.performance import year_split
    rows = year_split(kpi_ops.kpi_counts(points(spark, d)), 1998).withColumn(
        "value", F.col("value").cast("double"))
    return s.shares_within(rows, ["kpi_id", "reporting_quarter"]).select(
        "kpi_id", "reporting_quarter", "series", "value", x.rounded("pct").alias("pct"))


@query("a40_waived_share", f"""SELECT quarter, category, value, {o.rnd("CASE WHEN category='Total Inspections' THEN 100e0 ELSE 100e0*value/nullif(max(CASE WHEN category='Total Inspections' THEN value END) OVER (PARTITION BY quarter),0) END")} AS pct
 FROM (SELECT {o.qlabel('received_at')} AS quarter, 'Total Inspections' AS category, CAST(count(*) AS DOUBLE) AS value FROM f_valid WHERE process_code='GMP' AND activity_type IN ('inspection','waiver') GROUP BY 1
 UNION ALL SELECT {o.qlabel('received_at')}, 'Waived (Desk/Remote)', CAST(count(*) AS DOUBLE) FROM f_valid WHERE process_code='GMP' AND activity_type='waiver' GROUP BY 1)""")
def _(spark, d):
    rows = gold.valid_activities(spark, d).filter(
        (F.col("process_code") == "GMP") & F.col("activity_type").isin("inspection", "waiver"))
    counts = rows.groupBy(x.quarter_label("received_at").alias("quarter")).agg(
        F.count(F.lit(1)).cast("double").alias("Total Inspections"),
        F.nullif(F.count_if(F.col("activity_type") == "waiver"), F.lit(0)).cast("double")
        .alias("Waived (Desk/Remote)"))
    long = counts.unpivot("quarter", ["Total Inspections", "Waived (Desk/Remote)"], "category",
                          "value").filter(F.col("value").isNotNull())
    return s.waived_shares(long).withColumn("pct", x.rounded("pct"))


@query("a41_pool_periods", "SELECT process, count(DISTINCT quarter) AS quarters, count(DISTINCT metric_name) AS metrics FROM p_volumes GROUP BY 1")
def _(spark, d):
    return volume_pool(spark, d).groupBy("process").agg(
        F.countDistinct("quarter").alias("quarters"), F.countDistinct("metric_name").alias("metrics"))


# ---- query log ----------------------------------------------------------------------------------


def query_events(spark, d):
    """Completed-query events as the JSON a query engine would deliver, from the event table."""
    e = tables.read(spark, d, "events")
    kind, error = F.col("event_type"), F.col("event_type") == "error"

    def table(schema, suffix=None):
        return F.struct(F.lit("lake").alias("catalogName"), F.lit(schema).alias("schema"),
                        (kind if suffix is None else suffix).alias("table"))

    body = F.struct(
        F.struct(F.col("event_id").cast("string").alias("queryId"),
                 F.repeat(kind, F.when(F.col("event_id") % 100 == 0, 900).otherwise(3)).alias("query"),
                 F.when(F.col("event_id") % 3 == 0, F.when(error, "FAILED").otherwise("FINISHED"))
                 .alias("queryState")).alias("metadata"),
        F.struct(F.col("user_id").cast("string").alias("user"),
                 (F.col("user_id") % 7).cast("string").alias("principal"),
                 F.lit("bi").alias("source")).alias("context"),
        F.struct((F.col("value") / 100).alias("wallTime"),
                 F.get_json_object("props", "$.k").cast("long").alias("outputRows"))
        .alias("statistics"),
        F.when(error & (F.col("event_id") % 2 == 0),
               F.struct(F.struct(F.lit("USER_ERROR").alias("name")).alias("errorCode")))
        .alias("failureInfo"),
        F.when(error & (F.col("event_id") % 2 == 1), F.lit("EXCEEDED_LIMIT")).alias("errorCode"),
        F.struct(F.array(table("gold"), table("gold"), table("silver"),
                         table("silver", F.lit(None).cast("string"))).alias("inputs"))
        .alias("ioMetadata"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("endTime"))
    return e.select(F.to_json(body).alias("payload"))


o.register("a_log", """SELECT CAST(event_id AS VARCHAR) AS query_id, strftime(ts,'%Y-%m-%d %H:%M:%S') AS event_time,
 CAST(user_id AS VARCHAR) AS username, CAST(user_id%7 AS VARCHAR) AS principal, 'bi' AS source,
 CAST(NULL AS VARCHAR) AS catalog_name, CAST(NULL AS VARCHAR) AS schema_name,
 substr(repeat(event_type, CASE WHEN event_id%100=0 THEN 900 ELSE 3 END),1,4000) AS query_text,
 CASE WHEN event_id%3=0 THEN CASE WHEN event_type='error' THEN 'FAILED' ELSE 'FINISHED' END
  WHEN event_type='error' AND event_id%2=0 THEN 'FAILED' ELSE 'FINISHED' END AS state,
 CASE WHEN event_type='error' THEN CASE WHEN event_id%2=0 THEN 'USER_ERROR' ELSE 'EXCEEDED_LIMIT' END END AS error_code,
 CAST(0 AS BIGINT) AS cpu_ms, CAST(trunc(value/100*1000) AS BIGINT) AS wall_ms,
 CAST(json_extract_string(props,'$.k') AS BIGINT) AS rows_returned, CAST(0 AS BIGINT) AS bytes_scanned,
 'lake.gold.'||event_type||',lake.silver.'||event_type AS tables_accessed, strftime(ts,'%Y-%m-%d') AS audit_day FROM events""")


@query("s07_query_events", "SELECT * FROM a_log")
def _(spark, d):
    return audit_ops.audit_rows(query_events(spark, d))


@query("t11_audit_batches", "SELECT query_id, username, state, audit_day FROM a_log")
def _(spark, d):
    """The same events through the audit stream, in batches of one file."""
    root = removed_at_exit(spark, new_folder(spark, "audit"))
    query_events(spark, d).repartition(3).write.text(f"{root}/in")
    stream = spark.readStream.schema("payload string").option("maxFilesPerTrigger", 1).text(f"{root}/in")
    audit_log.start_audit(stream, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return audit_log.read_audit(spark, f"{root}/log").select("query_id", "username", "state", "audit_day")


@query("t11_flushed_events", """SELECT 'size' AS reason, CAST(count(*) // 5 AS BIGINT) AS flushes, CAST(5 * (count(*) // 5) AS BIGINT) AS events FROM a_log HAVING count(*) >= 5
 UNION ALL SELECT 'age', CAST(1 AS BIGINT), CAST(count(*) % 5 AS BIGINT) FROM a_log HAVING count(*) % 5 > 0""")
def _(spark, d):
    """The same events through a buffer that is handed on at five events, or when the oldest has waited a second."""
    root = removed_at_exit(spark, new_folder(spark, "flushes"))
    events = query_events(spark, d)
    events.write.text(f"{root}/in")
    stream = spark.readStream.schema("payload string").text(f"{root}/in")
    running = audit_log.start_flushing(stream, f"{root}/log", f"{root}/checkpoint", seconds=1, trigger="0 seconds")
    try:
        audit_log.handed_on(running, spark, f"{root}/log", events.count())
    finally:
        running.stop()
    flushes = audit_log.read_raw(spark, f"{root}/log").groupBy("flush", "reason").agg(F.count(F.lit(1)).alias("n"))
    return flushes.groupBy("reason").agg(F.count(F.lit(1)).alias("flushes"), F.sum("n").alias("events"))


def _register_lookup(entity: str) -> dict:
    """Stands for a registry: one kind of entity it refuses, another it never answers for."""
    if int(entity) % 30 == 0:
        raise ConnectionError(entity)
    if int(entity) % 40 == 0:
        time.sleep(30)
    return {"legal_name": f"registered {entity}", "country": "X", "risk_tier": "low", "registry_status": "active"}


@query("t10_enrichment", """SELECT c_custkey::VARCHAR AS entity_id, CASE WHEN c_custkey%30=0 OR c_custkey%40=0 THEN 'unavailable' ELSE 'enriched' END AS status,
 CASE WHEN c_custkey%30=0 OR c_custkey%40=0 THEN NULL ELSE 'registered '||c_custkey END AS legal_name
 FROM customer WHERE c_custkey%10=0 AND c_custkey IN (SELECT o_custkey FROM orders)""")
def _(spark, d):
    """Look-ups of the applicants without enrichment; calls that hang give a row and hold up nothing."""
    waiting = enrichment.pending(gold.applications(spark, d), tables.enrichment(spark, d))
    return enrichment.enrich(waiting, _register_lookup, partitions=4, attempts=1, timeout=1.0).select(
        "entity_id", "status", "legal_name")


@query("p13_event_projection", """SELECT query_id, state, error_code, tables_accessed, length(query_text)::INT AS text_length,
 principal FROM a_log""")
def _(spark, d):
    return audit_ops.audit_rows(query_events(spark, d)).select(
        "query_id", "state", "error_code", "tables_accessed",
        F.length("query_text").alias("text_length"), "principal")


@query("a32_usage_report", """SELECT username, state, count(*) AS queries, CAST(sum(rows_returned) AS BIGINT) AS rows_returned,
 string_agg(DISTINCT tables_accessed, ' | ' ORDER BY tables_accessed) AS touched FROM f_audit
 WHERE tables_accessed<>'' GROUP BY 1,2 ORDER BY 3 DESC, 1, 2 LIMIT 15""")
def _(spark, d):
    return audit_ops.usage_report(tables.audit_rows(spark, d))


@query("a32_weekly_usage", """SELECT CAST(date_trunc('week', CAST(audit_day AS DATE)) AS DATE) AS week, count(*) AS queries,
 count(DISTINCT username) AS users FROM f_audit GROUP BY 1""")
def _(spark, d):
    return audit_ops.weekly_usage(tables.audit_rows(spark, d))


@query("a32_denied", "SELECT principal, audit_day, count(*) AS failures FROM f_audit WHERE state='FAILED' GROUP BY 1,2")
def _(spark, d):
    return audit_ops.denied_report(tables.audit_rows(spark, d))


@query("o03_slowest_queries", """SELECT query_id, username, wall_ms FROM f_audit ORDER BY wall_ms DESC, query_id LIMIT 20""")
def _(spark, d):
    return (tables.audit_rows(spark, d).select("query_id", "username", "wall_ms")
            .orderBy(F.desc("wall_ms"), "query_id").limit(20))


@query("k09_impersonated_queries", "SELECT audit_day, count(*) AS queries FROM f_audit WHERE username IS DISTINCT FROM principal GROUP BY 1")
def _(spark, d):
    return audit_ops.impersonated(tables.audit_rows(spark, d)).groupBy("audit_day").agg(
        F.count(F.lit(1)).alias("queries"))


