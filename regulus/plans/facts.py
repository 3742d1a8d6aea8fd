"""Queries over the facts: state, validity, measurement fan-out, intake, joins and sets."""
from __future__ import annotations

from pyspark.sql import functions as F

from regulus import contract as c
from regulus.functions import columns as x
from regulus.operators import latest, marts, measurements as m, quality as q
from regulus.plans import oracle as o
from regulus.plans.registry import query
from regulus.sources import gold, tables

SINCE = "1997-01"
CUTOFF_MS = 872_000_000_000
ROUNDED = ", ".join(
    f"{o.rnd(n)} AS {n}" if n in ("touch_days", "wait_days") else n for n in c.FACT_COLUMNS)


def neat(df):
    """Facts with their measures rounded at the end."""
    return df.select(*[x.rounded(n).alias(n) if n in ("touch_days", "wait_days") else F.col(n)
                       for n in c.FACT_COLUMNS])


o.register("f_intake", f"""SELECT CASE WHEN event_id%17=0 THEN 'x' ELSE 'APP-' ||
  CAST(1000000 + user_id*37 + event_id%50 AS VARCHAR) END AS application_id,
  CASE WHEN event_id%11=0 THEN 'XX' ELSE CASE event_id%3 WHEN 0 THEN 'MA' WHEN 1 THEN 'CT' ELSE 'GMP' END END AS process_code,
  CASE event_type WHEN 'view' THEN 'new' WHEN 'click' THEN 'renewal' WHEN 'signup' THEN 'variation'
   WHEN 'purchase' THEN 'amendment' ELSE 'inspection' END AS application_type,
  CASE WHEN event_id%19=0 THEN 'by_post' ELSE {o.case('event_id', c.ROUTES)} END AS route,
  CASE WHEN event_id%13=0 THEN 'Bad Tenant' ELSE 'partner_alpha' END AS tenant_id,
  CAST(user_id AS VARCHAR) AS entity_id, epoch_us(ts)//1000 AS received_at, event_id FROM events""")
o.register("f_registry", "SELECT application_id, process_code FROM f_applications WHERE CAST(application_id AS BIGINT)%4<>0")


def intake(spark, d):
    """Submissions projected from the event table, some of them wrong in one way or another."""
    e = F.col("event_id")
    route = F.when(e % 19 == 0, "by_post")
    for index, name in enumerate(c.ROUTES[:-1]):
        route = route.when(e % 4 == index, name)
    return tables.read(spark, d, "events").select(
        F.when(e % 17 == 0, "x").otherwise(F.concat(F.lit("APP-"), (
            F.lit(1000000) + F.col("user_id") * 37 + e % 50).cast("string"))).alias("application_id"),
        F.when(e % 11 == 0, "XX").when(e % 3 == 0, "MA").when(e % 3 == 1, "CT").otherwise("GMP")
        .alias("process_code"),
        F.when(F.col("event_type") == "view", "new").when(F.col("event_type") == "click", "renewal")
        .when(F.col("event_type") == "signup", "variation")
        .when(F.col("event_type") == "purchase", "amendment").otherwise("inspection")
        .alias("application_type"),
        route.otherwise(c.ROUTES[-1]).alias("route"),
        F.when(e % 13 == 0, "Bad Tenant").otherwise("partner_alpha").alias("tenant_id"),
        F.col("user_id").cast("string").alias("entity_id"),
        x.epoch_ms("ts").alias("received_at"), "event_id")


def registry(spark, d):
    return (gold.applications(spark, d).filter(F.col("application_id").cast("long") % 4 != 0)
            .select("application_id", "process_code"))


# ---- state --------------------------------------------------------------------------------------
@query("w04_latest_state", f"""SELECT {ROUNDED} FROM f_history QUALIFY
 row_number() OVER (PARTITION BY record_id ORDER BY revision DESC)=1""")
def _(spark, d):
    return neat(latest.latest_state(gold.history(spark, d),
                                    ["application_id", "record_id"], ["revision"]))


@query("w12_state_as_of", f"""SELECT process_code, status, count(*) AS records, max(updated_at) AS last_update,
 CAST(count(completed_at) AS BIGINT) AS completed FROM (SELECT * FROM f_history WHERE updated_at <= {CUTOFF_MS}
 QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY revision DESC)=1) GROUP BY 1,2""")
def _(spark, d):
    return (latest.state_as_of(gold.history(spark, d), ["application_id", "record_id"],
                               ["revision"], CUTOFF_MS)
            .groupBy("process_code", "status").agg(
                F.count(F.lit(1)).alias("records"), F.max("updated_at").alias("last_update"),
                F.count("completed_at").alias("completed")))


@query("w09_previous_state", f"""SELECT record_id, revision, status, updated_at FROM f_history QUALIFY
 row_number() OVER (PARTITION BY record_id ORDER BY revision DESC)=2""")
def _(spark, d):
    return latest.nth_latest(
        gold.history(spark, d).select("record_id", "revision", "status", "updated_at"),
        ["record_id"], "revision", 2)


@query("s03_cohort_scan", f"""SELECT cohort_month, process_code, count(*) AS records FROM f_activities
 WHERE cohort_month >= '{SINCE}' GROUP BY 1,2""")
def _(spark, d):
    """A partitioned read from one month on: only those partitions are listed and opened."""
    return (gold.activities(spark, d).filter(F.col("cohort_month") >= SINCE)
            .groupBy("cohort_month", "process_code").agg(F.count(F.lit(1)).alias("records")))


# ---- validity -----------------------------------------------------------------------------------
@query("p01_valid_activities", f"SELECT {ROUNDED} FROM f_activities WHERE {o.VALID}")
def _(spark, d):
    return neat(q.valid(gold.activities(spark, d)))


@query("p02_quarantine", f"SELECT {ROUNDED} FROM f_activities WHERE NOT coalesce({o.VALID}, false)")
def _(spark, d):
    return neat(q.quarantine(gold.activities(spark, d)))


@query("k03_quarantine_evidence", f"""SELECT process_code, cohort_month, count(*) AS quarantined,
 min(record_id) AS first_record FROM f_activities WHERE NOT coalesce({o.VALID}, false) GROUP BY 1,2""")
def _(spark, d):
    return q.quarantine(gold.activities(spark, d)).groupBy("process_code", "cohort_month").agg(
        F.count(F.lit(1)).alias("quarantined"), F.min("record_id").alias("first_record"))


@query("p03_constraint_audit", """SELECT record_id, 'dates' AS violations FROM f_activities
 WHERE NOT (due_at>=received_at AND (completed_at IS NULL OR completed_at>=received_at))""")
def _(spark, d):
    return q.constraint_violations(gold.activities(spark, d)).select(
        "record_id", F.array_join("violations", ",").alias("violations"))


@query("p03_immutable_identity", """SELECT count(DISTINCT record_id) AS keys_checked, CAST(count(*) FILTER
 (WHERE changed) AS BIGINT) AS moved FROM (SELECT record_id, min(application_id)<>max(application_id) OR
 min(cohort_month)<>max(cohort_month) AS changed FROM f_history GROUP BY 1)""")
def _(spark, d):
    history = gold.history(spark, d)
    moved = q.moved_identities(history).agg(F.count(F.lit(1)).alias("moved"))
    keys = (history.select("record_id").distinct()
            .agg(F.count(F.lit(1)).alias("keys_checked")))
    return keys.withColumn("_k", F.lit(1)).join(moved.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("j16_parent_integrity", """SELECT activity_type, count(*) AS orphans FROM f_activities a WHERE NOT EXISTS
 (SELECT 1 FROM f_applications p WHERE p.record_id=a.application_id AND p.status<>'RECEIVED') GROUP BY 1""")
def _(spark, d):
    """Children of applications that are not under way yet count as orphans here."""
    started = gold.applications(spark, d).filter(F.col("status") != "RECEIVED")
    return q.orphans(gold.activities(spark, d), started).groupBy("activity_type").agg(
        F.count(F.lit(1)).alias("orphans"))


@query("g10_reconciliation", """SELECT 'differing' AS kind, count(*) AS rows FROM (SELECT * FROM
 (SELECT record_id, status, revision FROM f_history QUALIFY row_number() OVER (PARTITION BY record_id
 ORDER BY revision DESC)=1) EXCEPT ALL SELECT record_id, status, revision FROM f_activities)""")
def _(spark, d):
    """Source history reduced to its last state against the stored table: no row may differ."""
    columns = ["record_id", "status", "revision"]
    source = latest.latest_state(gold.history(spark, d).select("application_id", "cohort_month", *columns),
                                 ["application_id", "record_id"], ["revision"])
    return q.reconcile(source, gold.activities(spark, d), "cohort_month", columns).agg(
        F.count(F.lit(1)).alias("rows")).select(F.lit("differing").alias("kind"), "rows")


_SPOILT = "cohort_month IN ('1996-03', '1997-05') AND CAST(application_id AS BIGINT)%3=0"


@query("g10_changed_cohorts", f"""SELECT * FROM (SELECT cohort_month, record_id, status, CAST(1 AS BIGINT) AS expected_copies, CAST(0 AS BIGINT) AS actual_copies
 FROM f_activities WHERE {_SPOILT} AND cohort_month='1996-03'
 UNION ALL SELECT cohort_month, record_id, status || '?', 0, 1 FROM f_activities WHERE {_SPOILT} AND cohort_month='1996-03'
 UNION ALL SELECT cohort_month, record_id, status, 1, 2 FROM f_activities WHERE {_SPOILT} AND cohort_month='1997-05')""")
def _(spark, d):
    """A copy in which some rows of one cohort are altered and some of another doubled: fingerprints name the cohorts, and only those are compared."""
    good = gold.activities(spark, d)
    altered = good.withColumn("status", F.when(F.expr(f"{_SPOILT} AND cohort_month='1996-03'"), F.concat("status", F.lit("?"))).otherwise(F.col("status")))
    copy = altered.unionByName(good.filter(f"{_SPOILT} AND cohort_month='1997-05'"))
    return q.reconcile(good, copy, "cohort_month", ["record_id", "status"])


@query("u07_multiset_equality", """SELECT process_code, activity_type, route, expected_copies, actual_copies FROM
 (SELECT process_code, activity_type, route, count(*) AS expected_copies FROM f_activities GROUP BY 1,2,3)
 JOIN (SELECT process_code, activity_type, route, count(*) AS actual_copies FROM f_valid GROUP BY 1,2,3)
 USING (process_code, activity_type, route) WHERE expected_copies<>actual_copies""")
def _(spark, d):
    return q.multiset_difference(gold.activities(spark, d), gold.valid_activities(spark, d),
                                 ["process_code", "activity_type", "route"])


# ---- measurements -------------------------------------------------------------------------------
@query("p04_eligible_activities", """SELECT r.process_code, r.kpi_id, count(*) AS activities
 FROM f_valid a JOIN f_rules r ON a.process_code=r.process_code AND a.activity_type=r.activity_type
 AND (r.rule_type='' OR r.rule_type=a.application_type) AND (len(r.routes)=0 OR list_contains(r.routes,a.route))
 WHERE a.completed_at IS NOT NULL AND a.status='COMPLETED' GROUP BY 1,2""")
def _(spark, d):
    return (m.match_rules(m.completed(gold.valid_activities(spark, d)), m.rules(spark))
            .groupBy("process_code", "kpi_id").agg(F.count(F.lit(1)).alias("activities")))


@query("p05_measured_values", f"""SELECT kpi_id, sum(numerator)::BIGINT AS met, count(*) AS n,
 {o.rnd('sum(measured_value)', 4)} AS total FROM f_measurements GROUP BY 1""")
def _(spark, d):
    return gold.measurements(spark, d).groupBy("kpi_id").agg(
        F.sum("numerator").alias("met"), F.count(F.lit(1)).alias("n"),
        x.rounded(F.sum("measured_value"), 4).alias("total"))


_MEAS = ("SELECT measurement_id, cohort_month, application_id, activity_id, tenant_id, process_code, kpi_id, "
         f"reporting_quarter, {o.rnd('measured_value')} AS measured_value, numerator, denominator, updated_at "
         "FROM f_measurements")


@query("j03_rule_join", _MEAS)
def _(spark, d):
    return m.measurements(gold.valid_activities(spark, d)).withColumn(
        "measured_value", x.rounded("measured_value"))


@query("u02_rule_branches", _MEAS)
def _(spark, d):
    return m.measurements_by_branches(gold.valid_activities(spark, d)).withColumn(
        "measured_value", x.rounded("measured_value"))


@query("t07_measurement_fanout", """SELECT activity_id, count(*) AS measurements,
 string_agg(kpi_id, ',' ORDER BY kpi_id) AS indicators FROM f_measurements GROUP BY 1""")
def _(spark, d):
    """Indicators per activity; an activity matches a bounded number of rules."""
    return gold.measurements(spark, d).groupBy("activity_id").agg(
        F.count(F.lit(1)).alias("measurements"),
        F.array_join(F.array_sort(F.collect_list("kpi_id")), ",").alias("indicators"))


@query("s05_indicator_dimension", """SELECT r.process_code, r.kpi_id, r.aggregation, r.baseline, r.target,
 coalesce(n,0) AS observations FROM f_rules r LEFT JOIN (SELECT process_code, kpi_id, count(*) AS n
 FROM f_measurements GROUP BY 1,2) m ON r.process_code=m.process_code AND r.kpi_id=m.kpi_id""")
def _(spark, d):
    seen = gold.measurements(spark, d).groupBy("process_code", "kpi_id").agg(
        F.count(F.lit(1)).alias("observations"))
    return m.dim_kpi(spark).join(seen, ["process_code", "kpi_id"], "left").na.fill(0, ["observations"])


@query("p06_route_classes", """SELECT CASE WHEN route LIKE '%desk%' THEN 'desk' WHEN route LIKE '%reliance%'
 THEN 'reliance' WHEN route LIKE '%domestic%' THEN 'domestic' ELSE 'foreign' END AS route_class,
 count(*) AS records FROM f_activities GROUP BY 1""")
def _(spark, d):
    return gold.activities(spark, d).groupBy(x.route_class("route").alias("route_class")).agg(
        F.count(F.lit(1)).alias("records"))


# ---- unions, enrichment -------------------------------------------------------------------------
def by_process(df):
    """The three process tables the facts are stored as."""
    return [df.filter(F.col("process_code") == p) for p in c.PROCESSES]


@query("u01_all_applications", """SELECT process_code, count(*) AS records, min(received_at) AS first_received
 FROM f_applications GROUP BY 1""")
def _(spark, d):
    ma, ct, gmp = by_process(gold.applications(spark, d))
    return ma.unionByName(ct).unionByName(gmp).groupBy("process_code").agg(
        F.count(F.lit(1)).alias("records"), F.min("received_at").alias("first_received"))


def enriched_applications(apps, enrichment):
    """Applications with their looked-up attributes; not yet looked up reads as pending."""
    right = enrichment.select("entity_id", "legal_name", "country", "risk_tier", "registry_status",
                              F.col("status").alias("_status"))
    return (apps.join(right, "entity_id", "left")
            .withColumn("enrichment_status", F.coalesce("_status", F.lit("pending"))).drop("_status"))


@query("j02_enriched_applications", """SELECT a.record_id, a.entity_id, e.legal_name, e.country, e.risk_tier,
 e.registry_status, coalesce(e.status,'pending') AS enrichment_status FROM f_applications a
 LEFT JOIN f_enrichment e ON a.entity_id=e.entity_id""")
def _(spark, d):
    return enriched_applications(gold.applications(spark, d), tables.enrichment(spark, d)).select(
        "record_id", "entity_id", "legal_name", "country", "risk_tier", "registry_status",
        "enrichment_status")


def pending_entities(apps, enrichment):
    return apps.select("entity_id").distinct().join(
        enrichment.select("entity_id"), "entity_id", "left_anti")


@query("j04_pending_entities", """SELECT DISTINCT a.entity_id FROM f_applications a LEFT JOIN f_enrichment e
 ON a.entity_id=e.entity_id WHERE e.entity_id IS NULL""")
def _(spark, d):
    return pending_entities(gold.applications(spark, d), tables.enrichment(spark, d))


@query("j05_registry_backfill", """SELECT application_id, process_code FROM f_applications a WHERE NOT EXISTS
 (SELECT 1 FROM f_registry r WHERE r.application_id=a.application_id)""")
def _(spark, d):
    return gold.applications(spark, d).select("application_id", "process_code").join(
        registry(spark, d).select("application_id"), "application_id", "left_anti")


# ---- intake -------------------------------------------------------------------------------------
_TYPE_OK = " OR ".join(
    f"(process_code='{p}' AND application_type IN ({', '.join(o.text(t) for t in ts)}))"
    for p, ts in c.APPLICATION_TYPES.items())
o.register("f_checked", f"""SELECT *, concat_ws(',',
 CASE WHEN process_code NOT IN ('MA','CT','GMP') THEN 'process' END,
 CASE WHEN NOT ({_TYPE_OK}) THEN 'application_type' END,
 CASE WHEN route NOT IN ({', '.join(o.text(r) for r in c.ROUTES)}) THEN 'route' END,
 CASE WHEN NOT regexp_full_match(application_id, '[A-Za-z0-9:_-]{{8,64}}') THEN 'application_id' END,
 CASE WHEN NOT regexp_full_match(tenant_id, '[a-z][a-z0-9_]{{1,62}}') THEN 'tenant_id' END) AS reasons FROM f_intake""")


@query("p18_submission_validation", "SELECT event_id, application_id, reasons FROM f_checked")
def _(spark, d):
    return q.validate_submissions(intake(spark, d)).select(
        "event_id", "application_id", F.array_join("reasons", ",").alias("reasons"))


o.register("f_claims", """SELECT * FROM f_checked k WHERE reasons='' AND NOT EXISTS (SELECT 1 FROM f_registry r
 WHERE r.application_id=k.application_id) QUALIFY row_number() OVER (PARTITION BY application_id
 ORDER BY received_at, process_code, entity_id, application_type, route, tenant_id)=1""")


@query("p24_intake_rows", f"""SELECT application_id AS record_id, application_id, tenant_id, entity_id, process_code,
 application_type, 'application' AS activity_type, route, strftime(epoch_ms(received_at),'%Y-%m') AS cohort_month,
 received_at, received_at + 90*{o.DAY} AS due_at, CAST(NULL AS BIGINT) AS completed_at, received_at AS updated_at,
 'RECEIVED' AS status, CAST(NULL AS VARCHAR) AS outcome, 0e0 AS touch_days, 0e0 AS wait_days,
 CAST(1 AS INT) AS revision FROM f_claims""")
def _(spark, d):
    return q.intake_facts(q.first_claims(intake(spark, d), registry(spark, d)))


@query("j17_repeated_ids", """SELECT application_id, count(*) AS uses, string_agg(DISTINCT process_code, ','
 ORDER BY process_code) AS processes FROM (SELECT application_id, process_code FROM f_checked WHERE reasons=''
 UNION ALL SELECT application_id, process_code FROM f_registry
 UNION ALL SELECT application_id, process_code FROM f_applications) GROUP BY 1 HAVING count(*)>1""")
def _(spark, d):
    accepted = q.validate_submissions(intake(spark, d)).filter(F.size("reasons") == 0)
    return q.repeated_ids([accepted, registry(spark, d), gold.applications(spark, d)]).withColumn(
        "processes", F.array_join("processes", ","))


# ---- functions ----------------------------------------------------------------------------------
@query("f07_dates", f"""SELECT record_id, strftime(epoch_ms(received_at),'%Y-%m-%d') AS received_day,
 CAST(date_trunc('month', epoch_ms(received_at)) AS DATE) AS month_start,
 CAST(quarter(epoch_ms(received_at)) AS INT) AS quarter,
 date_sub('day', epoch_ms(received_at), epoch_ms(due_at)) AS whole_days,
 CAST(epoch_ms(received_at) AS DATE) + 90 AS plus_sla FROM f_applications""")
def _(spark, d):
    t = x.at("received_at")
    return gold.applications(spark, d).select(
        "record_id", F.date_format(t, "yyyy-MM-dd").alias("received_day"),
        F.trunc(F.to_date(t), "month").alias("month_start"), F.quarter(t).alias("quarter"),
        x.whole_days("received_at", "due_at").alias("whole_days"),
        F.date_add(F.to_date(t), 90).alias("plus_sla"))


@query("f05_hashed_ids", """SELECT record_id, upper(sha256(entity_id)) AS digest,
 substr(sha256('process=' || process_code || '|route=' || route), 1, 12) AS artifact_key FROM f_applications""")
def _(spark, d):
    parts = F.create_map(F.lit("route"), F.col("route"), F.lit("process"), F.col("process_code"))
    return gold.applications(spark, d).select(
        "record_id", F.upper(F.sha2("entity_id", 256)).alias("digest"),
        x.artifact_key(parts).alias("artifact_key"))


@query("f03_text", """SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z0-9._@:/-]+', '-', 'g') AS slug,
 regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g') AS sanitized, upper(p_type) AS upper_type,
 replace(p_name, ' ', '_') AS replaced, split_part(p_name, ' ', 1) AS first_word,
 starts_with(p_name, 'red') AS is_red, ends_with(p_name, 'bolt') AS is_bolt,
 contains(p_name, 'i') AS has_i FROM part""")
def _(spark, d):
    name = F.col("p_name")
    return tables.read(spark, d, "part").select(
        "p_partkey", x.slug("p_name").alias("slug"), x.sanitized("p_brand").alias("sanitized"),
        F.upper("p_type").alias("upper_type"), F.replace(name, F.lit(" "), F.lit("_")).alias("replaced"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"),
        name.startswith("red").alias("is_red"), name.endswith("bolt").alias("is_bolt"),
        name.contains("i").alias("has_i"))


@query("f10_arrays", """SELECT application_id, len(list(record_id)) AS records,
 array_to_string(list_sort(list(DISTINCT activity_type)), ',') AS kinds FROM f_activities GROUP BY 1""")
def _(spark, d):
    """Kinds of activity per application: counted by aggregate, a bounded set collected."""
    return gold.activities(spark, d).groupBy("application_id").agg(
        F.count("record_id").alias("records"),
        F.array_join(F.array_sort(F.collect_set("activity_type")), ",").alias("kinds"))


@query("f11_json_path", """SELECT event_id, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k,
 event_type || ':' || json_extract_string(props,'$.k') AS tag FROM events""")
def _(spark, d):
    props = F.from_json("props", "k bigint")
    return tables.read(spark, d, "events").select(
        "event_id", props["k"].alias("k"),
        F.concat("event_type", F.lit(":"), F.get_json_object("props", "$.k")).alias("tag"))


@query("o07_dataset_order", """SELECT process_code, activity_type, count(*) AS records FROM f_activities
 GROUP BY 1,2 ORDER BY process_code, activity_type""")
def _(spark, d):
    return gold.activities(spark, d).groupBy("process_code", "activity_type").agg(
        F.count(F.lit(1)).alias("records")).orderBy("process_code", "activity_type")


@query("p15_masked_applications", f"""SELECT record_id, application_id, tenant_id,
 'sha256:' || upper(sha256(entity_id)) AS entity_id, process_code, application_type, route, cohort_month, status
 FROM f_applications""")
def _(spark, d):
    from regulus.operators.governance import mask_facts
    return mask_facts(gold.applications(spark, d)).select(
        "record_id", "application_id", "tenant_id", "entity_id", "process_code",
        "application_type", "route", "cohort_month", "status")


@query("p16_masked_enrichment", """SELECT 'sha256:' || upper(sha256(entity_id)) AS entity_id,
 CAST(NULL AS VARCHAR) AS legal_name, CAST(NULL AS VARCHAR) AS country, risk_tier, registry_status, status
 FROM f_enrichment""")
def _(spark, d):
    from regulus.operators.governance import mask_enrichment
    return mask_enrichment(tables.enrichment(spark, d)).drop("enriched_at")


@query("k07_calendar", """SELECT CAST(d AS DATE) AS date_day, coalesce(r,0) AS received, coalesce(k,0) AS completed
 FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) g(d)
 LEFT JOIN (SELECT CAST(epoch_ms(received_at) AS DATE) AS d1, count(*) AS r FROM f_applications GROUP BY 1) ON d1=d
 LEFT JOIN (SELECT CAST(epoch_ms(completed_at) AS DATE) AS d2, count(*) AS k FROM f_applications
  WHERE completed_at IS NOT NULL GROUP BY 1) ON d2=d""")
def _(spark, d):
    from regulus.operators.performance import received_on
    return received_on(gold.applications(spark, d), marts.calendar(spark, "1995-01-01", "2001-12-31"))


@query("f01_string_functions", """SELECT record_id, process_code || '/' || route AS path, substr(cohort_month,1,4) AS year_text,
 lpad(CAST(revision AS VARCHAR), 3, '0') AS padded, CAST(substr(cohort_month,6,2) AS INT) AS month_number FROM f_applications""")
def _(spark, d):
    return gold.applications(spark, d).select(
        "record_id", F.concat("process_code", F.lit("/"), "route").alias("path"),
        F.substring("cohort_month", 1, 4).alias("year_text"),
        F.lpad(F.col("revision").cast("string"), 3, "0").alias("padded"),
        F.substring("cohort_month", 6, 2).cast("int").alias("month_number"))


@query("f02_escaped_like", r"""SELECT kpi_id, count(*) AS n FROM f_measurements WHERE kpi_id LIKE 'avg\_%' ESCAPE '\'
 OR kpi_id LIKE 'median\_%' ESCAPE '\' GROUP BY 1""")
def _(spark, d):
    return gold.measurements(spark, d).filter(x.lower_is_better("kpi_id")).groupBy("kpi_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("f06_pattern_match", """SELECT event_id, regexp_full_match(application_id, '[A-Za-z0-9:_-]{8,64}') AS id_ok,
 regexp_full_match(tenant_id, '[a-z][a-z0-9_]{1,62}') AS tenant_ok FROM f_intake""")
def _(spark, d):
    return intake(spark, d).select(
        "event_id", F.col("application_id").rlike(c.APPLICATION_ID_PATTERN).alias("id_ok"),
        F.col("tenant_id").rlike(c.TENANT_PATTERN).alias("tenant_ok"))


@query("f09_math", f"""SELECT record_id, {o.rnd('touch_days', 1)} AS rounded, CAST(ceil(touch_days) AS BIGINT) AS up,
 CAST(floor(touch_days) AS BIGINT) AS down, abs(revision-3) AS distance, nullif(revision, 3) AS not_three,
 coalesce(completed_at, updated_at) AS last_seen, least(greatest(revision, 2), 2) AS clamped FROM f_applications""")
def _(spark, d):
    r = F.col("revision")
    return gold.applications(spark, d).select(
        "record_id", x.rounded("touch_days", 1).alias("rounded"), F.ceil("touch_days").alias("up"),
        F.floor("touch_days").alias("down"), F.abs(r - 3).alias("distance"),
        F.nullif(r, F.lit(3)).alias("not_three"),
        F.coalesce("completed_at", "updated_at").alias("last_seen"),
        F.least(F.greatest(r, F.lit(2)), F.lit(2)).alias("clamped"))


@query("f12_conditions", """SELECT record_id, CASE status WHEN 'COMPLETED' THEN 'closed' WHEN 'RECEIVED' THEN 'new' ELSE 'open' END
 AS state, CASE WHEN due_at < updated_at THEN 1::INT ELSE 0::INT END AS late FROM f_applications""")
def _(spark, d):
    s = F.col("status")
    return gold.applications(spark, d).select(
        "record_id", F.when(s == "COMPLETED", "closed").when(s == "RECEIVED", "new").otherwise("open")
        .alias("state"), F.when(F.col("due_at") < F.col("updated_at"), 1).otherwise(0).alias("late"))
