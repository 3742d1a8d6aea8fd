"""Marts, metrics, volumes, steps, bottlenecks, backlog and the dashboard document."""
from __future__ import annotations

from pyspark.sql import functions as F

from regulus import contract as c
from regulus.functions import columns as x
from regulus.operators import answers, document, marts, measurements as m, performance as perf
from regulus.operators import semantic
from regulus.operators import kpi as kpi_ops
from regulus.plans import oracle as o
from regulus.plans.indicators import QUARTER, points, tenant_points
from regulus.plans.registry import query
from regulus.sources import gold

AS_OF_MS = 899_251_200_000

# ---- marts --------------------------------------------------------------------------------------
_DATE = "CAST(cohort_month || '-01' AS DATE)"


def _throughput_sql(source: str) -> str:
    return f"""SELECT process_code AS process, cohort_month AS arrival_month, {_DATE} AS arrival_date, application_type,
 route AS handling_route, count(*) AS applications_received, count(*) FILTER (WHERE status='COMPLETED') AS applications_completed,
 count(*) FILTER (WHERE status<>'COMPLETED') AS applications_open,
 count(*) FILTER (WHERE status<>'COMPLETED' AND due_at<{AS_OF_MS}) AS applications_overdue
 FROM {source} GROUP BY ALL"""


o.register("f_throughput", _throughput_sql("f_applications"))
_DAYS = "date_sub('day', to_timestamp(received_at//1000), to_timestamp(completed_at//1000))"
o.register("f_turnaround", f"""SELECT process_code AS process, activity_type AS activity, cohort_month AS arrival_month,
 {_DATE} AS arrival_date, route AS handling_route, count(*) AS completed_count,
 {o.rnd(f'avg({_DAYS})',1)} AS avg_turnaround_days,
 CAST(quantile_disc({_DAYS}, 0.5) AS DOUBLE) AS median_turnaround_days,
 {o.rnd('avg(touch_days)',1)} AS avg_working_days, {o.rnd('avg(wait_days)',1)} AS avg_waiting_days,
 {o.rnd('100e0*count(*) FILTER (WHERE completed_at<=due_at)/count(*)',1)} AS pct_on_time
 FROM f_valid WHERE completed_at IS NOT NULL AND status='COMPLETED' GROUP BY ALL""")
o.register("f_delay", f"""SELECT process_code AS process, activity_type AS workflow_stage, cohort_month AS arrival_month,
 {_DATE} AS arrival_date, count(*) AS times_performed, {o.rnd('avg(touch_days)',1)} AS avg_working_days,
 {o.rnd('avg(wait_days)',1)} AS avg_waiting_days, {o.rnd('avg(touch_days+wait_days)',1)} AS avg_elapsed_days,
 {o.rnd('100e0*sum(wait_days)/nullif(sum(touch_days+wait_days),0)',1)} AS pct_time_waiting,
 {o.rnd('100e0*count(*) FILTER (WHERE completed_at<=due_at)/nullif(count(completed_at),0)',1)} AS pct_stage_on_time
 FROM f_steps GROUP BY ALL""")
o.register("f_quality", f"""SELECT process_code AS process, activity_type AS activity, cohort_month AS arrival_month,
 {_DATE} AS arrival_date, route AS handling_route, count(*) AS assessments,
 count(*) FILTER (WHERE outcome='COMPLIANT') AS compliant_count,
 count(*) FILTER (WHERE outcome='NON_COMPLIANT') AS non_compliant_count,
 {o.rnd("100e0*count(*) FILTER (WHERE outcome='COMPLIANT')/nullif(count(*) FILTER (WHERE outcome IN ('COMPLIANT','NON_COMPLIANT')),0)",1)}
 AS pct_compliant FROM f_valid WHERE outcome IS NOT NULL GROUP BY ALL""")


def all_marts(spark, d):
    return {
        "application_throughput": marts.application_throughput(gold.applications(spark, d), AS_OF_MS),
        "turnaround_performance": marts.turnaround_performance(gold.valid_activities(spark, d)),
        "delay_analysis": marts.delay_analysis(gold.steps(spark, d)),
        "quality_metrics": marts.quality_metrics(gold.valid_activities(spark, d)),
        "indicator_performance": kpi_ops.indicator_performance(tenant_points(spark, d)),
    }


@query("a09_application_throughput", "SELECT * FROM f_throughput")
def _(spark, d):
    return marts.application_throughput(gold.applications(spark, d), AS_OF_MS)


@query("a10_turnaround_performance", "SELECT * FROM f_turnaround")
def _(spark, d):
    return marts.turnaround_performance(gold.valid_activities(spark, d))


@query("a10_turnaround_exact", f"""SELECT process_code AS process, activity_type AS activity, cohort_month AS arrival_month,
 {_DATE} AS arrival_date, route AS handling_route, count(*) AS completed_count,
 {o.rnd(f'quantile_cont(CAST({_DAYS} AS DOUBLE), 0.5)')} AS median_turnaround_days
 FROM f_valid WHERE completed_at IS NOT NULL AND status='COMPLETED' GROUP BY ALL""")
def _(spark, d):
    return marts.turnaround_performance(gold.valid_activities(spark, d), exact_median=True).select(
        "process", "activity", "arrival_month", "arrival_date", "handling_route", "completed_count",
        x.rounded("median_turnaround_days").alias("median_turnaround_days"))


@query("a11_delay_analysis", "SELECT * FROM f_delay")
def _(spark, d):
    return marts.delay_analysis(gold.steps(spark, d))


@query("a12_quality_metrics", "SELECT * FROM f_quality")
def _(spark, d):
    return marts.quality_metrics(gold.valid_activities(spark, d))


@query("p14_tenant_mart", _throughput_sql("f_applications WHERE tenant_id='partner_alpha'"))
def _(spark, d):
    return marts.application_throughput(
        marts.for_tenant(gold.applications(spark, d), "partner_alpha"), AS_OF_MS)


@query("g09_mart_bounds", """SELECT 'application_throughput' AS mart, process FROM f_throughput WHERE applications_overdue>applications_open
 UNION ALL SELECT 'quality_metrics', process FROM f_quality WHERE pct_compliant<0 OR pct_compliant>100
 UNION ALL SELECT 'turnaround_performance', process FROM f_turnaround WHERE pct_on_time<0 OR pct_on_time>100
  OR avg_turnaround_days<0""")
def _(spark, d):
    a = all_marts(spark, d)
    return marts.bound_violations(a["application_throughput"], a["quality_metrics"],
                                  a["turnaround_performance"])


@query("u03_union_of_tests", """SELECT 'application_throughput' AS mart, process, count(*) AS rows FROM f_throughput
 WHERE applications_overdue*2>applications_received GROUP BY 2 UNION ALL SELECT 'quality_metrics', process, count(*)
 FROM f_quality WHERE pct_compliant<50 GROUP BY 2""")
def _(spark, d):
    """Union of mart tests with thresholds that this data does exceed."""
    a = all_marts(spark, d)
    late = a["application_throughput"].filter(
        F.col("applications_overdue") * 2 > F.col("applications_received"))
    poor = a["quality_metrics"].filter(F.col("pct_compliant") < 50)
    return (late.select(F.lit("application_throughput").alias("mart"), "process")
            .unionByName(poor.select(F.lit("quality_metrics").alias("mart"), "process"))
            .groupBy("mart", "process").agg(F.count(F.lit(1)).alias("rows")))


@query("g12_publication_check", """SELECT product, rows, rows>0 AS published FROM (
 SELECT 'application_throughput' AS product, count(*) AS rows FROM f_throughput
 UNION ALL SELECT 'turnaround_performance', count(*) FROM f_turnaround UNION ALL SELECT 'delay_analysis', count(*) FROM f_delay
 UNION ALL SELECT 'quality_metrics', count(*) FROM f_quality
 UNION ALL SELECT 'indicator_performance', count(*) FROM f_indicator_performance)""")
def _(spark, d):
    return marts.publication_check(all_marts(spark, d))


@query("k06_published_views", "SELECT process, sum(applications_received)::BIGINT AS received FROM f_throughput GROUP BY 1")
def _(spark, d):
    marts.publish_views({"application_throughput": all_marts(spark, d)["application_throughput"]})
    return spark.sql("SELECT process, sum(applications_received) AS received "
                     "FROM application_throughput GROUP BY process")


# ---- metrics ------------------------------------------------------------------------------------
@query("a30_metric_by_stage", f"""SELECT workflow_stage, {o.rnd('avg(avg_waiting_days)')} AS delay_analysis_avg_waiting_days,
 {o.rnd('avg(pct_time_waiting)')} AS delay_analysis_pct_time_waiting,
 CAST(sum(times_performed) AS BIGINT) AS delay_analysis_times_performed FROM f_delay GROUP BY 1""")
def _(spark, d):
    names = ["delay_analysis_avg_waiting_days", "delay_analysis_pct_time_waiting",
             "delay_analysis_times_performed"]
    rows = semantic.metric_query(all_marts(spark, d), names, ["workflow_stage"])
    return rows.select("workflow_stage", *[x.rounded(n).alias(n) for n in names[:2]], names[2])


@query("a30_metric_over_time", f"""SELECT process, arrival_date AS metric_time,
 {o.rnd('quantile_cont(median_turnaround_days,0.5)')} AS turnaround_performance_median_turnaround_days,
 {o.rnd('avg(pct_on_time)')} AS turnaround_performance_pct_on_time FROM f_turnaround GROUP BY 1,2""")
def _(spark, d):
    names = ["turnaround_performance_median_turnaround_days", "turnaround_performance_pct_on_time"]
    rows = semantic.metric_query(all_marts(spark, d), names, ["process", "metric_time"], "month")
    return rows.select("process", "metric_time", *[x.rounded(n).alias(n) for n in names])


@query("a31_weighted_ratio", f"""SELECT handling_route,
 {o.rnd('100e0*sum(compliant_count)/nullif(sum(assessments),0)')} AS quality_metrics_compliance_rate,
 {o.rnd('avg(pct_compliant)')} AS quality_metrics_pct_compliant FROM f_quality GROUP BY 1""")
def _(spark, d):
    names = ["quality_metrics_compliance_rate", "quality_metrics_pct_compliant"]
    rows = semantic.metric_query(all_marts(spark, d), names, ["handling_route"])
    return rows.select("handling_route", *[x.rounded(n).alias(n) for n in names])


@query("a31_weighted_wait", f"""SELECT process_code, step, {o.rnd('100e0*sum(w)/nullif(sum(e),0)')} AS weighted_pct,
 {o.rnd('avg(100e0*w/nullif(e,0))')} AS unweighted_pct FROM (SELECT process_code, activity_type AS step, cohort_month,
 sum(wait_days) AS w, sum(touch_days+wait_days) AS e FROM f_steps GROUP BY 1,2,3) GROUP BY 1,2""")
def _(spark, d):
    return perf.weighted_wait(gold.steps(spark, d)).select(
        "process_code", "step", x.rounded("weighted_pct").alias("weighted_pct"),
        x.rounded("unweighted_pct").alias("unweighted_pct"))


# ---- volumes ------------------------------------------------------------------------------------
def _case(mapping, key, pick=lambda v: v):
    whens = " ".join(
        f"WHEN process_code='{p}' AND {key}='{k}' THEN '{pick(v)}'"
        for p, names in mapping.items() for k, v in names.items() if pick(v))
    return f"CASE {whens} END"


_CLASS = ("CASE WHEN route LIKE '%desk%' THEN 'desk' WHEN route LIKE '%reliance%' THEN 'reliance' "
          "WHEN route LIKE '%domestic%' THEN 'domestic' ELSE 'foreign' END")
_OKC = "coalesce(outcome='COMPLIANT',false)"
o.register("f_volume_counts", f"""SELECT process_code, quarter, metric, count(*) AS value FROM (
 SELECT process_code, {o.qlabel('received_at')} AS quarter, 'applications_received' AS metric FROM f_applications
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, 'applications_completed' FROM f_applications
 UNION ALL SELECT process_code, {o.qlabel('received_at')}, {_case(c.TYPE_VOLUMES, 'application_type')} FROM f_applications
 UNION ALL SELECT process_code, {o.qlabel('received_at')}, 'reliance_used_count' FROM f_applications
  WHERE process_code='MA' AND contains(route,'reliance')
 UNION ALL SELECT process_code, {o.qlabel('received_at')}, {_case(c.ACTIVITY_VOLUMES, 'activity_type', lambda v: v[0])} FROM f_valid
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, {_case(c.ACTIVITY_VOLUMES, 'activity_type', lambda v: v[1])} FROM f_valid
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, CASE WHEN {_OKC} THEN 'compliant_facilities' ELSE 'non_compliant_facilities' END
  FROM f_valid WHERE activity_type='inspection' AND process_code<>'CT'
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, CASE {_CLASS} WHEN 'desk' THEN 'desk_based_inspections'
  WHEN 'reliance' THEN 'inspections_reliance_joint' WHEN 'domestic' THEN 'inspections_domestic' ELSE 'inspections_foreign' END
  FROM f_valid WHERE activity_type='inspection' AND process_code<>'CT') WHERE quarter IS NOT NULL AND metric IS NOT NULL GROUP BY 1,2,3""")
o.register("f_volumes", f"""SELECT s.process_code, s.quarter, n.metric, coalesce(v.value,0) AS value
 FROM (SELECT DISTINCT process_code, quarter FROM f_volume_counts) s
 JOIN ({o.values(perf.volume_metrics())}) AS n(process_code,metric) ON n.process_code=s.process_code
 LEFT JOIN f_volume_counts v ON v.process_code=s.process_code AND v.quarter=s.quarter AND v.metric=n.metric""")
_INSP = "FROM f_valid WHERE activity_type='inspection'"
o.register("f_inspections", f"""SELECT process_code, quarter, metric, CAST(sum(w) AS BIGINT) AS value FROM (
 SELECT process_code, {o.qlabel('received_at')} AS quarter, 'requested_'||{_CLASS} AS metric, 1 AS w {_INSP}
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, 'conducted_'||{_CLASS}, 1 {_INSP}
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, 'compliant_'||{_CLASS}, CAST({_OKC} AS INT) {_INSP}
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, 'sites_assessed', 1 {_INSP} AND process_code='CT'
 UNION ALL SELECT process_code, {o.qlabel('completed_at')}, 'compliant_sites', CAST({_OKC} AS INT) {_INSP} AND process_code='CT')
 WHERE quarter IS NOT NULL GROUP BY 1,2,3""")


# The sections below are computed by the queries named after them, and read by all others from
# serving tables that are written once.
@query("a16_quarterly_volumes", "SELECT * FROM f_volumes")
def compute_volumes(spark, d):
    return perf.quarterly_volumes(gold.applications(spark, d), gold.valid_activities(spark, d))


@query("a17_inspection_volumes", "SELECT * FROM f_inspections")
def compute_inspections(spark, d):
    return perf.inspection_volumes(gold.valid_activities(spark, d))


def volumes(spark, d):
    return gold.stored(spark, d, "volumes", lambda: compute_volumes(spark, d))


def inspections(spark, d):
    return gold.stored(spark, d, "inspections", lambda: compute_inspections(spark, d))


@query("p27_combined_route", """SELECT process_code, quarter, CAST(coalesce(max(CASE WHEN metric='requested_reliance' THEN value END),0)
 + coalesce(max(CASE WHEN metric='requested_desk' THEN value END),0) AS BIGINT) AS requested_reliance_desk FROM f_inspections GROUP BY 1,2""")
def _(spark, d):
    return perf.combined_route(inspections(spark, d), "requested")


_WORK = f"""SELECT quarter, received, completed, received-completed AS net, CAST(sum(received-completed) OVER
 (ORDER BY {o.qindex('quarter')} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS open_at_end FROM (SELECT quarter,
 CAST(sum(CASE WHEN metric='applications_received' THEN value ELSE 0 END) AS BIGINT) AS received,
 CAST(sum(CASE WHEN metric='applications_completed' THEN value ELSE 0 END) AS BIGINT) AS completed FROM f_volumes GROUP BY 1)"""


@query("a25_workload_and_backlog", f"""SELECT *, CASE WHEN net>0 THEN 'grew' WHEN net<0 THEN 'shrank' ELSE 'held steady' END
 AS direction FROM ({_WORK})""")
def _(spark, d):
    return answers.workload(volumes(spark, d))


@query("w03_running_backlog", f"SELECT quarter, open_at_end FROM ({_WORK})")
def _(spark, d):
    return answers.workload(volumes(spark, d)).select("quarter", "open_at_end")


# ---- steps and bottlenecks ----------------------------------------------------------------------
_CYCLE = "CAST(completed_at-received_at AS DOUBLE)/86400000e0"
o.register("f_step_performance", f"""SELECT process_code, activity_type AS step, {o.qlabel('completed_at')} AS quarter,
 avg({_CYCLE}) AS avg_days, avg(CAST(due_at-received_at AS DOUBLE)/86400000e0) AS target_days
 FROM f_steps WHERE completed_at IS NOT NULL GROUP BY 1,2,3""")
o.register("f_bottlenecks", f"""SELECT process_code, activity_type AS step, {o.qlabel('completed_at')} AS quarter,
 quantile_cont({_CYCLE},0.5) AS cycle_time_median, quantile_cont(touch_days,0.5) AS touch_median_days,
 quantile_cont(wait_days,0.5) AS wait_median_days FROM f_steps WHERE completed_at IS NOT NULL GROUP BY 1,2,3""")


def step_points(spark, d):
    return gold.stored(spark, d, "step_points",
                       lambda: perf.step_performance(gold.steps(spark, d)))


def step_medians(spark, d):
    return gold.stored(spark, d, "step_medians", lambda: perf.bottlenecks(gold.steps(spark, d)))


def neat(df, *names):
    return df.withColumns({n: x.rounded(n) for n in names})


def sql_neat(relation, names, rest, where=""):
    return f"SELECT {rest}, {', '.join(f'{o.rnd(n)} AS {n}' for n in names)} FROM {relation} {where}"


@query("a18_step_performance", sql_neat("f_step_performance", ["avg_days", "target_days"],
                                        "process_code, step, quarter"))
def _(spark, d):
    return neat(perf.step_performance(gold.steps(spark, d)), "avg_days", "target_days")


_BN = ["cycle_time_median", "touch_median_days", "wait_median_days"]


@query("a19_bottleneck_medians", sql_neat("f_bottlenecks", _BN, "process_code, step, quarter"))
def _(spark, d):
    return neat(perf.bottlenecks(gold.steps(spark, d)), *_BN)


@query("a44_wait_share_and_tails", f"""SELECT process_code, activity_type AS step, {o.qlabel('completed_at')} AS quarter,
 {o.rnd('100e0*sum(wait_days)/nullif(sum(touch_days+wait_days),0)')} AS wait_share_pct,
 {o.rnd('quantile_cont(touch_days,0.9)')} AS touch_p90_days, {o.rnd('quantile_cont(wait_days,0.9)')} AS wait_p90_days
 FROM f_steps WHERE completed_at IS NOT NULL GROUP BY 1,2,3""")
def _(spark, d):
    return neat(perf.wait_shares(gold.steps(spark, d)), "wait_share_pct", "touch_p90_days", "wait_p90_days")


_STATUS = "CASE WHEN avg_days<=target_days THEN 'success' WHEN avg_days<target_days*1.05e0 THEN 'warning' ELSE 'error' END"
_GENERAL = "NOT (" + " OR ".join(f"ends_with(step,'{s}')" for s in c.STEP_SUFFIXES) + ")"


@query("p09_step_status", f"SELECT process_code, step, quarter, {_STATUS} AS status FROM f_step_performance")
def _(spark, d):
    return step_points(spark, d).select("process_code", "step", "quarter",
                                        x.step_status("avg_days", "target_days").alias("status"))


@query("p26_step_table", f"""SELECT process_code, step, {o.rnd('avg_days')} AS avg_days, {o.rnd('target_days')} AS target_days,
 {_STATUS} AS status FROM f_step_performance WHERE quarter='{QUARTER}' AND avg_days IS NOT NULL AND target_days IS NOT NULL""")
def _(spark, d):
    return neat(perf.step_table(step_points(spark, d), QUARTER), "avg_days", "target_days")


@query("a21_step_status_counts", f"""SELECT process_code, count(*) FILTER (WHERE s='success') AS success,
 count(*) FILTER (WHERE s='warning') AS warning, count(*) FILTER (WHERE s='error') AS error FROM
 (SELECT process_code, {_STATUS} AS s FROM f_step_performance WHERE quarter='{QUARTER}' AND {_GENERAL}) GROUP BY 1""")
def _(spark, d):
    return perf.step_status_counts(step_points(spark, d), QUARTER)


@query("p20_steps_for_choice", f"""SELECT process_code, step, quarter FROM (SELECT *, bool_or(ends_with(step,'_domestic'))
 OVER (PARTITION BY process_code, quarter) AS a FROM f_step_performance)
 WHERE CASE WHEN a THEN ends_with(step,'_domestic') ELSE {_GENERAL} END""")
def _(spark, d):
    return perf.steps_for_choice(step_points(spark, d), "_domestic").select(
        "process_code", "step", "quarter")


_ALLOW = [(p, k, s) for p, ks in c.INDICATOR_STEPS.items() for k, steps in ks.items() for s in steps]


@query("j21_relevant_steps", f"""SELECT a.process_code, a.kpi_id, a.step, quarter, {o.rnd('avg_days')} AS avg_days,
 {o.rnd('target_days')} AS target_days FROM f_step_performance p JOIN ({o.values(_ALLOW)}) AS a(process_code,kpi_id,step)
 ON a.process_code=p.process_code AND a.step=p.step WHERE avg_days IS NOT NULL AND target_days IS NOT NULL""")
def _(spark, d):
    allow = m.inline(spark, "process_code, kpi_id, step", _ALLOW)
    return neat(perf.relevant_steps(step_points(spark, d), allow), "avg_days", "target_days")


_TOUCH, _WAIT = "coalesce(touch_median_days,0)", "coalesce(wait_median_days,0)"
o.register("f_time_lost", f"""SELECT process_code AS process, step AS stage, {o.rnd(_TOUCH,1)} AS being_worked_on,
 {o.rnd(_WAIT,1)} AS waiting_in_queue, {o.rnd(f'{_TOUCH}+{_WAIT}',1)} AS total_days FROM f_bottlenecks WHERE quarter='{QUARTER}'""")


@query("a24_where_is_time_lost", "SELECT * FROM f_time_lost")
def _(spark, d):
    return answers.time_lost(step_medians(spark, d), QUARTER)


@query("a24_time_lost_summary", f"""SELECT count(*) AS stages, {o.rnd('sum(total_days)',1)} AS total_days,
 {o.rnd('sum(waiting_in_queue)',1)} AS waiting_days, {o.rnd('100e0*sum(waiting_in_queue)/nullif(sum(total_days),0)',0)} AS waiting_share,
 max(struct_pack(a:=total_days,b:=stage,c:=process)).c AS slowest_process,
 max(struct_pack(a:=total_days,b:=stage,c:=process)).b AS slowest_stage,
 max(struct_pack(a:=total_days,b:=stage,c:=process)).a AS slowest_days FROM f_time_lost""")
def _(spark, d):
    return answers.time_lost_answer(step_medians(spark, d), QUARTER)


@query("f15_unpivot", """SELECT process, stage, 'being_worked_on' AS time_type, being_worked_on AS days FROM f_time_lost
 UNION ALL SELECT process, stage, 'waiting_in_queue', waiting_in_queue FROM f_time_lost""")
def _(spark, d):
    return answers.time_lost(step_medians(spark, d), QUARTER).unpivot(
        ["process", "stage"], ["being_worked_on", "waiting_in_queue"], "time_type", "days")


o.register("f_compare", f"""SELECT s.process, indicators, met_target, median_stage_days,
 {o.rnd('100e0*met_target/indicators',0)} AS pct_meeting_target FROM
 (SELECT process, count(*) AS indicators, count(*) FILTER (WHERE met) AS met_target FROM f_scores
  WHERE quarter='{QUARTER}' AND met IS NOT NULL GROUP BY 1) s LEFT JOIN
 (SELECT process_code AS process, {o.rnd('avg(coalesce(cycle_time_median,0))',1)} AS median_stage_days FROM f_bottlenecks
  WHERE quarter='{QUARTER}' GROUP BY 1) b ON s.process=b.process""")


@query("a26_compare_processes", "SELECT * FROM f_compare")
def _(spark, d):
    return answers.compare_processes(points(spark, d), step_medians(spark, d), QUARTER)


@query("j09_best_and_worst", """SELECT min(struct_pack(a:=-pct_meeting_target,b:=process)).b AS best_process,
 max(pct_meeting_target) AS best_pct, min(struct_pack(a:=pct_meeting_target,b:=process)).b AS worst_process,
 min(pct_meeting_target) AS worst_pct FROM f_compare""")
def _(spark, d):
    return answers.best_and_worst(
        answers.compare_processes(points(spark, d), step_medians(spark, d), QUARTER))


@query("a46_step_time_fallback", f"""SELECT process_code, step, quarter, {o.rnd(
 "coalesce(CASE WHEN starts_with(step,'Queries') THEN cycle_time_median END, CASE WHEN starts_with(step,'Inspection Planning') THEN wait_median_days END, "
 "CASE WHEN coalesce(touch_median_days,0)+coalesce(wait_median_days,0)>0 THEN coalesce(touch_median_days,0)+coalesce(wait_median_days,0) END)")}
 AS step_days FROM f_bottlenecks""")
def _(spark, d):
    """External time of applicant queries, scheduling time of planning, else touch plus wait."""
    external = F.when(F.col("step").startswith("Queries"), F.col("cycle_time_median"))
    scheduling = F.when(F.col("step").startswith("Inspection Planning"), F.col("wait_median_days"))
    return step_medians(spark, d).select("process_code", "step", "quarter", x.rounded(
        perf.step_time(external, scheduling, F.col("touch_median_days"),
                       F.col("wait_median_days"))).alias("step_days"))


# ---- backlog ------------------------------------------------------------------------------------
def _qi(ms):
    return f"CAST(year(epoch_ms({ms}))*4+quarter(epoch_ms({ms}))-1 AS INT)"


def _spine(relation, keys):
    return f"""SELECT {keys}, unnest(generate_series(a,b)) AS q FROM (SELECT {keys}, min({_qi('received_at')}) AS a,
 max(greatest({_qi('received_at')}, coalesce({_qi('completed_at')},0))) AS b FROM {relation} GROUP BY {keys})"""


_START = "epoch_ms(make_timestamp(CAST(q//4 AS BIGINT), CAST(q%4*3+1 AS BIGINT), 1, 0, 0, 0.0))"
_END = "epoch_ms(make_timestamp(CAST((q+1)//4 AS BIGINT), CAST((q+1)%4*3+1 AS BIGINT), 1, 0, 0, 0.0))"
_LABEL = "('Q' || CAST(q%4+1 AS VARCHAR) || ' ' || CAST(q//4 AS VARCHAR))"
o.register("b_spine", f"SELECT process_code, q, {_START} AS s, {_END} AS e FROM ({_spine('f_applications', 'process_code')})")
o.register("b_step_spine", f"""SELECT process_code, step, q, {_START} AS s, {_END} AS e FROM
 ({_spine("(SELECT *, activity_type AS step FROM f_steps)", "process_code, step")})""")
_OPEN = "(completed_at IS NULL OR completed_at>={0})"
_AGE = "((e-received_at)//86400000)"


@query("a42_backlog", f"""SELECT process_code, {_LABEL} AS quarter,
 count(*) FILTER (WHERE received_at<s AND {_OPEN.format('s')}) AS opening_backlog,
 count(*) FILTER (WHERE received_at>=s AND received_at<e) AS received,
 count(*) FILTER (WHERE completed_at>=s AND completed_at<e) AS completed,
 {o.rnd(f"100e0*count(*) FILTER (WHERE received_at<e AND {_OPEN.format('e')})/nullif(count(*) FILTER (WHERE received_at<s AND {_OPEN.format('s')}) + count(*) FILTER (WHERE received_at>=s AND received_at<e),0)")} AS carry_over_rate,
 count(*) FILTER (WHERE received_at<e AND {_OPEN.format('e')}) AS closing_backlog,
 count(*) FILTER (WHERE received_at<e AND {_OPEN.format('e')} AND {_AGE}<=30) AS age_0_30,
 count(*) FILTER (WHERE received_at<e AND {_OPEN.format('e')} AND {_AGE} BETWEEN 31 AND 60) AS age_31_60,
 count(*) FILTER (WHERE received_at<e AND {_OPEN.format('e')} AND {_AGE} BETWEEN 61 AND 90) AS age_61_90,
 count(*) FILTER (WHERE received_at<e AND {_OPEN.format('e')} AND {_AGE}>90) AS age_90_plus
 FROM b_spine JOIN f_applications USING (process_code) GROUP BY process_code, q""")
def _(spark, d):
    return perf.backlog(gold.applications(spark, d), ["process_code"])


o.register("d_step_counts", f"""SELECT process_code, step, {_LABEL} AS quarter,
 count(*) FILTER (WHERE received_at>=s AND received_at<e) AS started_q,
 count(*) FILTER (WHERE completed_at>=s AND completed_at<e) AS completed_q,
 count(*) FILTER (WHERE received_at<e AND {_OPEN.format('e')}) AS open_end_q
 FROM b_step_spine JOIN (SELECT *, activity_type AS step FROM f_steps) USING (process_code, step) GROUP BY process_code, step, q""")


@query("a43_step_counts", "SELECT * FROM d_step_counts")
def _(spark, d):
    return perf.step_counts(gold.steps(spark, d))


# ---- document -----------------------------------------------------------------------------------
def _section(name, series, quarter, measures, source):
    return [f"SELECT '{name}' AS section, process_code AS process, {series} AS name, {quarter} AS quarter, '{m}' AS measure, {o.rnd(v)} AS value FROM {source} WHERE {v} IS NOT NULL"
            for m, v in measures.items()]


_SHARE = "starts_with(kpi_id,'pct_')"
_POINTS_SQL = " UNION ALL ".join([
    *_section("quarterlyData", "kpi_id", "reporting_quarter", {"value": "value"}, "f_points"),
    *_section("processStepData", "step", "quarter", {"avgDays": "avg_days", "targetDays": "target_days"}, "f_step_performance"),
    *_section("quarterlyVolumes", "metric", "quarter", {"count": "value"}, "f_volumes"),
    *_section("kpiCounts", "kpi_id", "reporting_quarter", {
        "numerator": f"(CASE WHEN {_SHARE} THEN numerator END)", "denominator": f"(CASE WHEN {_SHARE} THEN denominator END)",
        "sample_n": f"(CASE WHEN NOT {_SHARE} THEN denominator END)"}, "f_points"),
    *_section("inspectionVolumes", "metric", "quarter", {"count": "value"}, "f_inspections"),
    *_section("bottleneckData", "step", "quarter", {n: n for n in _BN}, "f_bottlenecks"),
    *_section("processStepCounts", "step", "quarter", {n: n for n in ("started_q", "completed_q", "open_end_q")}, "d_step_counts")])


def sections(spark, d):
    """All sections of the dashboard in long form."""
    steps, all_points = step_points(spark, d), points(spark, d)
    return document.long_sections([
        document.section("quarterlyData", all_points, "kpi_id", "reporting_quarter", {"value": "value"}),
        document.section("processStepData", steps, "step", "quarter", {"avgDays": "avg_days", "targetDays": "target_days"}),
        document.section("quarterlyVolumes", volumes(spark, d), "metric", "quarter", {"count": "value"}),
        document.section("kpiCounts", kpi_ops.kpi_counts(all_points), "kpi_id", "reporting_quarter",
                         {n: n for n in ("numerator", "denominator", "sample_n")}),
        document.section("inspectionVolumes", inspections(spark, d), "metric", "quarter", {"count": "value"}),
        document.section("bottleneckData", perf.bottlenecks(gold.steps(spark, d)), "step", "quarter", {n: n for n in _BN}),
        document.section("processStepCounts", perf.step_counts(gold.steps(spark, d)), "step", "quarter",
                         {n: n for n in ("started_q", "completed_q", "open_end_q")})])


@query("k10_dashboard_document", f"""SELECT section, process, name, count(DISTINCT quarter) AS quarters, {o.rnd('sum(value)', 3)} AS total,
 min(quarter) AS first_label FROM ({_POINTS_SQL}) GROUP BY 1,2,3""")
def _(spark, d):
    """Every series of the document: its quarters, the sum of all its values and its least quarter label, read from the body."""
    docs = document.documents(sections(spark, d))
    flat = docs.select("section", "process", "name", F.from_json("body", document.BODY_SCHEMA)["data"].alias("data"))
    total = F.aggregate(F.flatten(F.transform("data", lambda p: F.map_values(p["measures"]))), F.lit(0.0), lambda a, v: a + v)
    return flat.select("section", "process", "name", F.size("data").cast("long").alias("quarters"),
                       x.rounded(total, 3).alias("total"), F.array_min(F.transform("data", lambda p: p["quarter"])).alias("first_label"))


@query("s04_document_source", _POINTS_SQL)
def _(spark, d):
    """Documents written as JSON and read back with all required sections: the flattened points are the ones that went in."""
    from regulus.session import new_folder, removed_at_exit
    path = removed_at_exit(spark, new_folder(spark, "document")) + "/rows"
    document.documents(sections(spark, d)).write.json(path)
    return document.flatten(document.read_documents(spark, path)).withColumn("value", x.rounded("value"))
