"""Queries over indicator points: values, status, windows, trends and answers."""
from __future__ import annotations

from pyspark.sql import functions as F

from regulus import contract as c
from regulus.functions import columns as x
from regulus.operators import answers, kpi, measurements as m, quality as q
from regulus.operators import sketches
from regulus.operators.quantiles import exact_quantiles
from regulus.plans import oracle as o
from regulus.plans.registry import query
from regulus.sources import gold

QUARTER, EARLIER = "Q2 1998", "Q2 1997"


def points_from_facts(spark, d):
    return kpi.kpi_from_facts(gold.valid_activities(spark, d))


def points(spark, d):
    """Tenant-free indicator points, from the serving table."""
    return gold.stored(spark, d, "points", lambda: points_from_facts(spark, d))


def tenant_points(spark, d):
    return kpi.kpi_quarterly(gold.measurements(spark, d))


_KPI = f"""SELECT tenant_id, process_code, kpi_id, reporting_quarter, baseline, target, numerator, denominator,
 updated_at, {o.rnd('value')} AS value FROM f_kpi"""


def flagship(spark, d):
    """Quarterly indicators against their targets, straight from the given tables."""
    return tenant_points(spark, d).withColumn("value", x.rounded("value"))


@query("a01_kpi_quarterly", _KPI)
def _(spark, d):
    return flagship(spark, d)


@query("j01_measurements_with_targets", """SELECT m.process_code, m.kpi_id, any_value(r.target) AS target,
 CAST(count(*) AS BIGINT) AS n FROM f_measurements m JOIN f_rules r ON m.process_code=r.process_code
 AND m.kpi_id=r.kpi_id GROUP BY 1,2""")
def _(spark, d):
    return (gold.measurements(spark, d).groupBy("process_code", "kpi_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .join(F.broadcast(m.dim_kpi(spark).select("process_code", "kpi_id", "target")),
                  ["process_code", "kpi_id"]))


@query("a02_exact_median", f"""SELECT process_code, activity_type,
 {o.rnd("quantile_cont(CAST(completed_at-received_at AS DOUBLE)/86400000e0, 0.5)")} AS median_days
 FROM f_valid WHERE completed_at IS NOT NULL GROUP BY 1,2""")
def _(spark, d):
    days = gold.valid_activities(spark, d).select(
        "process_code", "activity_type", x.duration_days("received_at", "completed_at").alias("days"))
    return exact_quantiles(days, ["process_code", "activity_type"], "days").select(
        "process_code", "activity_type", x.rounded("median").alias("median_days"))


def turnaround_sketches(spark, d):
    """Sketches of the whole-day turnaround by cohort month, process, activity and route; every coarser median comes from them."""
    days = x.whole_days("received_at", "completed_at")
    return gold.stored(spark, d, "turnaround-sketches", lambda: sketches.sketches(
        gold.valid_activities(spark, d), ["cohort_month", "process_code", "activity_type", "route"], days), "cohort_month")


def _checked(spark, d, keys: list[str]):
    facts = gold.valid_activities(spark, d).withColumn("arrival_year", F.substring("cohort_month", 1, 4))
    stored = turnaround_sketches(spark, d).withColumn("arrival_year", F.substring("cohort_month", 1, 4))
    return sketches.within_bound(sketches.merged(stored, keys), facts, keys, x.whole_days("received_at", "completed_at"))


@query("a03_approximate_median", """SELECT process_code, CAST(quantile_disc(CAST((completed_at-received_at)//86400000
 AS BIGINT), 0.5) AS BIGINT) AS median_days, count(*) AS n, true AS within_bound FROM f_valid WHERE completed_at IS NOT NULL GROUP BY 1""")
def _(spark, d):
    """Approximate medians of whole processes over the facts; those from the monthly sketches are checked against the facts too."""
    facts = gold.valid_activities(spark, d).filter(F.col("completed_at").isNotNull())
    medians = facts.groupBy("process_code").agg(F.percentile_approx(x.whole_days("received_at", "completed_at"), 0.5, 10000).alias("median_days"))
    checked = _checked(spark, d, ["process_code"]).withColumnRenamed("process_code", "_p")
    return medians.join(checked, F.col("process_code").eqNullSafe(F.col("_p"))).select("process_code", "median_days", "n", "within_bound")


@query("a10_rolled_up_medians", """SELECT substr(cohort_month, 1, 4) AS arrival_year, process_code, route, count(*) AS n, true AS within_bound
 FROM f_valid WHERE completed_at IS NOT NULL GROUP BY 1, 2, 3""")
def _(spark, d):
    """The turnaround mart's median by year and route, from the same sketches."""
    return _checked(spark, d, ["arrival_year", "process_code", "route"])


@query("a04_conditional_counts", """SELECT process_code, CAST(count(*) FILTER (WHERE outcome='COMPLIANT') AS BIGINT)
 AS compliant, CAST(count(*) FILTER (WHERE outcome<>'COMPLIANT') AS BIGINT) AS other FROM f_valid GROUP BY 1""")
def _(spark, d):
    return gold.valid_activities(spark, d).groupBy("process_code").agg(
        F.count_if(F.col("outcome") == "COMPLIANT").alias("compliant"),
        F.count_if(F.col("outcome") != "COMPLIANT").alias("other"))


@query("a05_safe_ratio", f"""SELECT process_code, activity_type, {o.rnd("100e0*count(*) FILTER (WHERE outcome='COMPLIANT')"
 "/nullif(count(*) FILTER (WHERE outcome IN ('COMPLIANT','NON_COMPLIANT') AND route='on_site_domestic'),0)", 1)} AS pct
 FROM f_valid GROUP BY 1,2""")
def _(spark, d):
    decided = F.col("outcome").isin("COMPLIANT", "NON_COMPLIANT") & (F.col("route") == "on_site_domestic")
    return gold.valid_activities(spark, d).groupBy("process_code", "activity_type").agg(
        x.rounded(x.percent(F.count_if(F.col("outcome") == "COMPLIANT"), F.count_if(decided)), 1)
        .alias("pct"))


_PERF = f"""SELECT tenant_id, process_code AS process, kpi_id AS indicator, reporting_quarter AS quarter,
 CAST(substr(reporting_quarter,4,4) || '-' || lpad(CAST((CAST(substr(reporting_quarter,2,1) AS INT)-1)*3+1 AS VARCHAR),2,'0')
  || '-01' AS DATE) AS quarter_start, {o.rnd('value')} AS indicator_value, target AS indicator_target,
 baseline AS indicator_baseline, numerator, denominator,
 CASE WHEN target IS NULL THEN 'No target' WHEN {o.lower_better('kpi_id')} THEN
  CASE WHEN value<=target THEN 'Met target' ELSE 'Below target' END
  ELSE CASE WHEN value>=target THEN 'Met target' ELSE 'Below target' END END AS target_status FROM f_kpi"""
o.register("f_indicator_performance", _PERF)


@query("a13_indicator_performance", "SELECT * FROM f_indicator_performance")
def _(spark, d):
    return kpi.indicator_performance(tenant_points(spark, d)).withColumn(
        "indicator_value", x.rounded("indicator_value"))


@query("p07_target_status", """SELECT process, indicator, target_status, count(*) AS quarters
 FROM f_indicator_performance GROUP BY 1,2,3""")
def _(spark, d):
    return kpi.indicator_performance(tenant_points(spark, d)).groupBy(
        "process", "indicator", "target_status").agg(F.count(F.lit(1)).alias("quarters"))


@query("a14_kpi_from_facts", f"""SELECT process_code, kpi_id, reporting_quarter, baseline, target, numerator,
 denominator, {o.rnd('value')} AS value FROM f_points""")
def _(spark, d):
    return points_from_facts(spark, d).drop("updated_at").withColumn("value", x.rounded("value"))


@query("a15_kpi_counts", """SELECT process_code, kpi_id, reporting_quarter,
 CASE WHEN starts_with(kpi_id,'pct_') THEN numerator END AS numerator,
 CASE WHEN starts_with(kpi_id,'pct_') THEN denominator END AS denominator,
 CASE WHEN NOT starts_with(kpi_id,'pct_') THEN denominator END AS sample_n FROM f_points""")
def _(spark, d):
    return kpi.kpi_counts(points(spark, d))


@query("a39_rates_from_counts", f"""SELECT process_code, kpi_id, reporting_quarter, numerator, denominator,
 CASE WHEN denominator>0 THEN {o.rnd('100e0*numerator/denominator', 1)} ELSE 0e0 END AS value FROM f_points
 WHERE starts_with(kpi_id,'pct_')""")
def _(spark, d):
    return kpi.rates_from_counts(points(spark, d).filter(F.col("kpi_id").startswith("pct_")))


@query("p08_traffic_light", f"""SELECT process_code, kpi_id, reporting_quarter,
 {o.light('kpi_id', 'value', 'target')} AS status FROM f_points""")
def _(spark, d):
    return kpi.with_status(points(spark, d)).select(
        "process_code", "kpi_id", "reporting_quarter", "status")


o.register("f_scores", f"""SELECT process_code AS process, kpi_id, reporting_quarter AS quarter,
 {o.rnd('value',1)} AS value, {o.rnd('target',1)} AS target, {o.met('kpi_id','value','target')} AS met,
 {o.gap('kpi_id','value','target')} AS shortfall, CASE WHEN {o.lower_better('kpi_id')} THEN 'days' ELSE '%' END AS unit
 FROM f_points WHERE value IS NOT NULL""")


@query("p10_met_and_shortfall", "SELECT * FROM f_scores")
def _(spark, d):
    return kpi.indicator_scores(points(spark, d))


_OK, _WARN, _BAD = (f"100e0*{n}/total" for n in ("success", "warning", "error"))


@query("a20_indicator_status_counts", f"""SELECT process_code, success, warning, error, unknown, total,
 {o.rnd(_OK,1)} AS pct_success, {o.rnd(_WARN,1)} AS pct_warning, {o.rnd(_BAD,1)} AS pct_error,
 CASE WHEN {_BAD}>=50 THEN 'critical' WHEN {_WARN}>=50 THEN 'elevated risk' WHEN {_OK}>=70 THEN 'strong'
  WHEN {_OK}>=50 THEN 'moderate' WHEN error>warning AND error>success THEN 'mixed trending negative' ELSE 'mixed' END AS headline
 FROM (SELECT process_code, count(*) FILTER (WHERE s='success') AS success, count(*) FILTER (WHERE s='warning') AS warning,
  count(*) FILTER (WHERE s='error') AS error, count(*) FILTER (WHERE s='unknown') AS unknown, count(*) AS total
  FROM (SELECT process_code, {o.light('kpi_id','value','target')} AS s FROM f_points WHERE reporting_quarter='{QUARTER}')
  GROUP BY 1)""")
def _(spark, d):
    return answers.status_counts(points(spark, d), QUARTER)


@query("a22_are_we_meeting_targets", f"""SELECT quarter, count(*) FILTER (WHERE met) AS met, count(*) AS total,
 count(*) FILTER (WHERE NOT met) AS missed,
 max(CASE WHEN NOT met THEN struct_pack(a:=shortfall, b:=kpi_id, c:=process) END).c AS worst_process,
 max(CASE WHEN NOT met THEN struct_pack(a:=shortfall, b:=kpi_id, c:=process) END).b AS worst_indicator,
 max(CASE WHEN NOT met THEN struct_pack(a:=shortfall, b:=kpi_id, c:=process) END).a AS worst_gap
 FROM f_scores WHERE quarter='{QUARTER}' AND met IS NOT NULL GROUP BY 1""")
def _(spark, d):
    return answers.targets_answer(points(spark, d), QUARTER)


@query("o02_missed_by_gap", f"""SELECT process, kpi_id, value, target, shortfall, unit FROM f_scores
 WHERE quarter='{QUARTER}' AND NOT met ORDER BY shortfall DESC, process, kpi_id""")
def _(spark, d):
    return answers.missed_targets(points(spark, d), QUARTER).drop("quarter", "met")


o.register("f_trend", f"""SELECT process_code, kpi_id, {o.rnd('v0',1)} AS first_value, {o.rnd('v1',1)} AS last_value,
 {o.rnd('v1-v0',1)} AS change, CASE WHEN abs({o.rnd('v1-v0',9)})>=0.5 THEN CASE WHEN ({o.lower_better('kpi_id')} AND v1<v0)
  OR (NOT {o.lower_better('kpi_id')} AND v1>v0) THEN 'Improving' ELSE 'Declining' END ELSE 'Little change' END AS direction
 FROM (SELECT process_code, kpi_id, max(value) FILTER (WHERE reporting_quarter='{EARLIER}') AS v0,
  max(value) FILTER (WHERE reporting_quarter='{QUARTER}') AS v1 FROM f_points GROUP BY 1,2)
 WHERE v0 IS NOT NULL AND v1 IS NOT NULL""")


@query("a23_improving_or_declining", "SELECT * FROM f_trend")
def _(spark, d):
    return answers.trend_between(points(spark, d), EARLIER, QUARTER)


@query("a23_trend_summary", """SELECT count(*) FILTER (WHERE direction='Improving') AS improving,
 count(*) FILTER (WHERE direction='Declining') AS declining,
 count(*) FILTER (WHERE direction='Little change') AS little_change,
 max(CASE WHEN direction='Declining' THEN struct_pack(s:=abs(change), p:=process_code, k:=kpi_id) END).p AS worst_process,
 max(CASE WHEN direction='Declining' THEN struct_pack(s:=abs(change), p:=process_code, k:=kpi_id) END).k AS worst_indicator,
 max(CASE WHEN direction='Declining' THEN struct_pack(s:=abs(change), p:=process_code, k:=kpi_id) END).s AS worst_size
 FROM f_trend""")
def _(spark, d):
    return answers.trend_answer(points(spark, d), EARLIER, QUARTER)


_LAG = "lag(value) OVER (PARTITION BY process_code,kpi_id ORDER BY " + o.qindex("reporting_quarter") + ")"


@query("w01_quarter_delta", f"""SELECT process_code, kpi_id, reporting_quarter, {o.rnd('value')} AS value, delta,
 CASE WHEN delta>0 THEN 'up' WHEN delta<0 THEN 'down' ELSE 'flat' END AS trend,
 CASE WHEN delta IS NULL THEN NULL WHEN delta=0 THEN 'neutral' WHEN ({o.lower_better('kpi_id')} AND delta<0) OR
  (NOT {o.lower_better('kpi_id')} AND delta>0) THEN 'good' ELSE 'bad' END AS judgement
 FROM (SELECT *, {o.rnd('value-'+_LAG)} AS delta FROM f_points)""")
def _(spark, d):
    return answers.quarter_deltas(points(spark, d))


@query("w06_last_points", f"""SELECT process_code, kpi_id, reporting_quarter, {o.rnd('value')} AS value FROM f_points
 QUALIFY row_number() OVER (PARTITION BY process_code,kpi_id ORDER BY {o.qindex('reporting_quarter')} DESC)<=6""")
def _(spark, d):
    return answers.last_points(points(spark, d)).select(
        "process_code", "kpi_id", "reporting_quarter", x.rounded("value").alias("value"))


@query("w07_scaled_history", f"""SELECT process_code, kpi_id, reporting_quarter, {o.rnd(
 "(value-min(value) OVER s)/CASE WHEN max(value) OVER s - min(value) OVER s=0 THEN 1 ELSE max(value) OVER s - min(value) OVER s END")}
 AS scaled FROM f_points WHERE {o.qindex('reporting_quarter')} <= {o.qindex(o.text(QUARTER))}
 WINDOW s AS (PARTITION BY process_code,kpi_id)""")
def _(spark, d):
    return answers.scaled_history(points(spark, d), QUARTER)


@query("o01_chronological_points", f"""SELECT reporting_quarter, count(*) AS points FROM f_points GROUP BY 1
 ORDER BY {o.qindex('reporting_quarter')}""")
def _(spark, d):
    return (points(spark, d).groupBy("reporting_quarter").agg(F.count(F.lit(1)).alias("points"))
            .orderBy(x.quarter_index("reporting_quarter")))


@query("p11_quarter_range", f"""SELECT process_code, kpi_id, reporting_quarter, {o.rnd('value')} AS value FROM f_points
 WHERE {o.qindex('reporting_quarter')} BETWEEN {o.qindex(o.text(EARLIER))} AND {o.qindex(o.text(QUARTER))}""")
def _(spark, d):
    from regulus.operators.selfservice import in_period
    return in_period(points(spark, d), "reporting_quarter", quarters=(QUARTER, EARLIER)).select(
        "process_code", "kpi_id", "reporting_quarter", x.rounded("value").alias("value"))


@query("p12_membership", f"""SELECT process_code, kpi_id, reporting_quarter, {o.rnd('value')} AS value FROM f_points
 WHERE process_code IN ('MA','CT') AND kpi_id IN ('pct_fir_responses_on_time','pct_gcp_compliant')""")
def _(spark, d):
    return points(spark, d).filter(
        F.col("process_code").isin("MA", "CT")
        & F.col("kpi_id").isin("pct_fir_responses_on_time", "pct_gcp_compliant")).select(
        "process_code", "kpi_id", "reporting_quarter", x.rounded("value").alias("value"))


LINKS = [(f"{base}_{suffix}", base, label) for base, choices in c.DISAGGREGATIONS.items()
         for label, suffix in choices.items()]
_LINKS = "(" + o.values(LINKS) + ") AS l(kpi_id, base_kpi, choice)"


def links(spark):
    return m.inline(spark, "kpi_id, base_kpi, choice", LINKS)


@query("p25_trend_with_target", f"""SELECT process_code, kpi_id AS base_kpi, reporting_quarter, 'value' AS series,
 {o.rnd('value')} AS value FROM f_points
 UNION ALL SELECT process_code, kpi_id, reporting_quarter, 'target', target FROM f_points
 UNION ALL SELECT process_code, kpi_id, reporting_quarter, 'baseline', baseline FROM f_points
 UNION ALL SELECT process_code, l.base_kpi, reporting_quarter, l.choice, {o.rnd('value')} FROM f_points p
  JOIN {_LINKS} ON l.kpi_id=p.kpi_id""")
def _(spark, d):
    return answers.trend_with_target(points(spark, d), links(spark))


@query("p20_effective_indicator", f"""SELECT p.process_code, p.kpi_id AS base_kpi, coalesce(l.kpi_id,p.kpi_id) AS kpi_id,
 p.reporting_quarter, {o.rnd('coalesce(k.value, CASE WHEN l.kpi_id IS NULL THEN p.value END)')} AS value
 FROM f_points p LEFT JOIN (SELECT * FROM {_LINKS} WHERE choice='On-site Domestic') l ON l.base_kpi=p.kpi_id
 LEFT JOIN f_points k ON k.kpi_id=l.kpi_id AND k.process_code=p.process_code AND k.reporting_quarter=p.reporting_quarter
 WHERE p.kpi_id NOT IN (SELECT kpi_id FROM {_LINKS})""")
def _(spark, d):
    """Each base indicator shown through a route choice, or itself where the choice has no child."""
    all_points = points(spark, d).select("process_code", "kpi_id", "reporting_quarter", "value")
    table = links(spark)
    base = all_points.join(F.broadcast(table.select("kpi_id")), "kpi_id", "left_anti")
    chosen = F.broadcast(table.filter(F.col("choice") == "On-site Domestic").select(
        F.col("base_kpi"), F.col("kpi_id").alias("child")))
    kids = all_points.select("process_code", F.col("kpi_id").alias("child"), "reporting_quarter",
                             F.col("value").alias("child_value"))
    rows = (base.withColumnRenamed("kpi_id", "base_kpi").join(chosen, "base_kpi", "left")
            .join(kids, ["process_code", "child", "reporting_quarter"], "left"))
    return rows.select("process_code", "base_kpi",
                       F.coalesce("child", "base_kpi").alias("kpi_id"), "reporting_quarter",
                       x.rounded(F.coalesce("child_value", F.when(F.col("child").isNull(), F.col("value"))))
                       .alias("value"))


@query("f17_progress", f"""SELECT process_code, kpi_id, reporting_quarter, {o.rnd(
 f"least(100e0, CASE WHEN {o.lower_better('kpi_id')} THEN 100e0*target/nullif(value,0) ELSE 100e0*value/target END)")} AS progress
 FROM f_points""")
def _(spark, d):
    return points(spark, d).select("process_code", "kpi_id", "reporting_quarter", x.rounded(
        x.progress("kpi_id", "value", "target")).alias("progress"))


@query("f08_quarter_labels", f"""SELECT DISTINCT reporting_quarter, {o.qindex('reporting_quarter')} AS quarter_index,
 make_date(CAST(substr(reporting_quarter,4,4) AS INT), (CAST(substr(reporting_quarter,2,1) AS INT)-1)*3+1, 1) AS quarter_start
 FROM f_points""")
def _(spark, d):
    return points(spark, d).select("reporting_quarter").distinct().select(
        "reporting_quarter", x.quarter_index("reporting_quarter").alias("quarter_index"),
        x.quarter_start("reporting_quarter").alias("quarter_start"))


@query("a38_count_bounds", """SELECT count(*) FILTER (WHERE numerator>denominator) AS numerator_exceeds_denominator,
 count(*) FILTER (WHERE numerator<0) AS negative_numerator, count(*) FILTER (WHERE denominator<=0) AS empty_denominator
 FROM f_kpi""")
def _(spark, d):
    return q.count_issues(tenant_points(spark, d))


@query("j14_published_against_counts", f"""SELECT process_code, kpi_id, reporting_quarter,
 'numerator_exceeds_denominator' AS kind, n AS numerator, denominator FROM f_published WHERE n>denominator
 UNION ALL SELECT process_code, kpi_id, reporting_quarter, 'percentage_disagrees_with_counts', n, denominator
 FROM f_published WHERE denominator>0 AND abs(CAST(n AS DOUBLE)/denominator*100-published)>0.01""")
def _(spark, d):
    """Published one-decimal shares against counts that were recorded with one case too many
    in every first quarter."""
    shares = points(spark, d).filter(F.col("kpi_id").startswith("pct_"))
    first = F.col("reporting_quarter").startswith("Q1")
    counts = shares.select("process_code", "kpi_id", "reporting_quarter", "denominator",
                           (F.col("numerator") + F.when(first, 1).otherwise(0)).alias("numerator"))
    published = shares.select("process_code", "kpi_id", "reporting_quarter",
                              x.rounded("value", 1).alias("published"))
    return q.published_disagreements(published, counts)


o.register("f_published", f"""SELECT *, numerator + CASE WHEN starts_with(reporting_quarter,'Q1') THEN 1 ELSE 0 END AS n,
 {o.rnd('value',1)} AS published FROM f_points WHERE starts_with(kpi_id,'pct_')""")


@query("g08_negative_measures", f"""SELECT 'points.' || process_code || '.' || kpi_id || '.' || reporting_quarter || '.gap'
 AS path, {o.gap('kpi_id','value','target')} AS value FROM f_points WHERE {o.gap('kpi_id','value','target')}<0""")
def _(spark, d):
    """Negative values with their path; gaps are the one measure here that can be negative."""
    rows = points(spark, d).select(
        F.lit("points").alias("section"), F.col("process_code").alias("process"),
        F.col("kpi_id").alias("name"), F.col("reporting_quarter").alias("quarter"),
        F.lit("gap").alias("measure"), x.shortfall("kpi_id", "value", "target").alias("value"))
    return q.negative_values(rows)


@query("a41_periods_and_metrics", """SELECT process_code, count(DISTINCT reporting_quarter) AS quarters,
 count(DISTINCT kpi_id) AS metrics FROM f_points GROUP BY 1""")
def _(spark, d):
    return points(spark, d).groupBy("process_code").agg(
        F.countDistinct("reporting_quarter").alias("quarters"),
        F.countDistinct("kpi_id").alias("metrics"))


@query("a45_year_split", """SELECT process_code, kpi_id, reporting_quarter, series, value FROM (
 SELECT process_code, kpi_id, reporting_quarter, 'meeting' AS series, numerator AS value FROM f_points
  WHERE starts_with(kpi_id,'pct_') AND ends_with(reporting_quarter,' 1998')
 UNION ALL SELECT process_code, kpi_id, reporting_quarter, 'not_meeting', denominator-numerator FROM f_points
  WHERE starts_with(kpi_id,'pct_') AND ends_with(reporting_quarter,' 1998'))""")
def _(spark, d):
    from regulus.operators.performance import year_split
    rows = year_split(kpi.kpi_counts(points(spark, d)), 1998)
    return rows.select("process_code", "kpi_id", "reporting_quarter", "series", "value")
