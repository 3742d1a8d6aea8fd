"""ANSI SQL twins: named relations for DuckDB and the small helpers that compose them.

``complete(body)`` puts the relations that a body mentions in front of it, in dependency order.
"""
from __future__ import annotations

import re

from regulus import contract as c
from regulus.sources import tables as t

DAY = "CAST(86400000 AS BIGINT)"


def text(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}e0"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (tuple, list)):
        return "CAST([" + ", ".join(text(v) for v in value) + "] AS VARCHAR[])"
    return "'" + str(value).replace("'", "''") + "'"


def values(rows) -> str:
    return "VALUES " + ",\n".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)


def rnd(expr: str, digits: int = 6) -> str:
    """Half-up rounding through decimals, the twin of ``functions.columns.rounded``."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def ts(ms: str) -> str:
    return f"epoch_ms({ms})"


def qlabel(ms: str) -> str:
    return f"('Q' || quarter({ts(ms)}) || ' ' || year({ts(ms)}))"


def qindex(label: str) -> str:
    return f"(CAST(substr({label},4,4) AS INT)*4 + CAST(substr({label},2,1) AS INT) - 1)"


def lower_better(kpi: str) -> str:
    return f"(starts_with({kpi},'avg_') OR starts_with({kpi},'median_'))"


def case(expr: str, names) -> str:
    whens = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names[:-1]))
    return f"CASE {expr} % {len(names)} {whens} ELSE '{names[-1]}' END"


def light(kpi: str, v: str, target: str) -> str:
    return (f"CASE WHEN {v} IS NULL OR {target} IS NULL THEN 'unknown' WHEN {lower_better(kpi)} THEN "
            f"CASE WHEN {v}<={target} THEN 'success' WHEN {v}<={target}*1.05e0 THEN 'warning' ELSE 'error' END "
            f"ELSE CASE WHEN {v}>={target} THEN 'success' WHEN {v}>={target}*0.95e0 THEN 'warning' ELSE 'error' END END")


def met(kpi: str, v: str, target: str) -> str:
    return (f"CASE WHEN {target} IS NOT NULL THEN CASE WHEN {lower_better(kpi)} THEN {v}<={target} "
            f"ELSE {v}>={target} END END")


def gap(kpi: str, v: str, target: str) -> str:
    return rnd(f"CASE WHEN {lower_better(kpi)} THEN {v}-{target} ELSE {target}-{v} END", 1)


VALID = ("record_id IS NOT NULL AND tenant_id IS NOT NULL AND cohort_month IS NOT NULL "
         "AND received_at IS NOT NULL AND due_at >= received_at "
         "AND (completed_at IS NULL OR completed_at >= received_at) "
         "AND touch_days >= 0 AND wait_days >= 0 AND revision > 0")
_ROUTES4 = c.ROUTES
_HIST = ",".join(t.HISTORY_ORDER)
_FACTS = ",".join(c.FACT_COLUMNS)
_STAGE = "CASE " + " ".join(
    f"WHEN process_code={text(p)} AND p_type={text(k)} THEN {text(n)}"
    for p, names in t.STAGES.items() for k, n in zip(t.PART_TYPES, names)) + " ELSE p_type END"


def _children(lines: str, due: str, suffix: str, activity: str, extra: str = "") -> str:
    ms = "epoch_ms(l_shipdate)"
    return f"""SELECT {_FACTS} FROM (
 SELECT CAST(l_orderkey*10+l_linenumber AS VARCHAR) || '{suffix}' AS record_id, application_id, tenant_id,
  entity_id, process_code, application_type, {case('l_suppkey', _ROUTES4)} AS route, cohort_month,
  l_linenumber, {extra}
  {ms} - CAST(floor(l_quantity) AS BIGINT)*{DAY} AS received_at,
  {ms} - CAST(floor(l_quantity) AS BIGINT)*{DAY} + ({due})*{DAY} AS due_at,
  CASE WHEN l_linestatus='F' THEN {ms} END AS completed_at, {ms} AS updated_at,
  CASE WHEN l_linestatus='F' THEN 'COMPLETED' ELSE 'IN_REVIEW' END AS status,
  CASE WHEN l_linestatus='F' THEN CASE l_returnflag WHEN 'A' THEN 'COMPLIANT' WHEN 'R' THEN 'NON_COMPLIANT'
   ELSE 'APPROVED' END END AS outcome,
  l_quantity*(1-5*l_discount) AS touch_days, l_quantity*5*l_discount AS wait_days,
  CAST(revision AS INT) AS revision
 FROM {lines} JOIN f_dossiers ON l_orderkey=o_orderkey) x, LATERAL (SELECT {activity} AS activity_type) y"""


_ACTIVITY = """CASE process_code
 WHEN 'MA' THEN CASE WHEN l_linenumber=2 THEN 'fir_response' WHEN l_linenumber=3 THEN 'query_response'
  WHEN l_linenumber IN (4,5) THEN 'decision' ELSE 'evaluation' END
 WHEN 'CT' THEN CASE l_linenumber WHEN 2 THEN 'inspection' WHEN 3 THEN 'safety_report' WHEN 4 THEN 'registration'
  WHEN 5 THEN 'capa' WHEN 6 THEN 'decision' ELSE 'evaluation' END
 ELSE CASE WHEN l_linenumber=1 THEN 'waiver' WHEN l_linenumber IN (2,6) THEN 'inspection' WHEN l_linenumber=3 THEN 'capa'
  WHEN l_linenumber=5 THEN 'report' ELSE 'decision' END END"""

_MEDIAN = "quantile_cont({0}, 0.5)"

RELATIONS: dict[str, str] = {
    "f_dossiers": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  {case('n_regionkey', ['internal', 'partner_alpha', 'partner_beta'])} AS tenant_id,
  CAST(o_orderkey AS VARCHAR) AS application_id, CAST(o_custkey AS VARCHAR) AS entity_id,
  {case('o_orderkey', ['MA', 'CT', 'GMP'])} AS process_code,
  CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'new'
    WHEN o_orderpriority='3-MEDIUM' THEN 'renewal' ELSE 'variation' END
   WHEN 1 THEN CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 'new' ELSE 'amendment' END
   ELSE 'inspection' END AS application_type, strftime(o_orderdate,'%Y-%m') AS cohort_month
 FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey""",
    "f_lines": f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey,l_linenumber ORDER BY {_HIST}) AS revision
 FROM lineitem""",
    "f_current_lines": """SELECT * FROM (SELECT *, max(revision) OVER (PARTITION BY l_orderkey,l_linenumber) AS last_revision
 FROM f_lines) WHERE revision=last_revision""",
    "f_step_lines": "SELECT * FROM f_current_lines JOIN part ON l_partkey=p_partkey",
    "f_history": _children("f_lines", "CASE WHEN l_tax=0.08 THEN -1 ELSE 30 END", "", _ACTIVITY),
    "f_activities": _children("f_current_lines", "CASE WHEN l_tax=0.08 THEN -1 ELSE 30 END", "", _ACTIVITY),
    "f_steps": _children(
        "f_step_lines", "10 + p_size % 30", "-s",
        f"""{_STAGE} || CASE WHEN process_code='GMP' AND p_size % 5 = 0 THEN CASE route
  WHEN 'on_site_domestic' THEN '_domestic' WHEN 'on_site_foreign' THEN '_foreign'
  WHEN 'reliance_joint_on_site_foreign' THEN '_reliance_joint_on_site_foreign'
  ELSE '_reliance_joint_desk_based_foreign' END ELSE '' END""", "p_type, p_size,"),
    "f_applications": f"""SELECT application_id AS record_id, application_id, tenant_id, entity_id, process_code,
  application_type, 'application' AS activity_type, {case('o_custkey', _ROUTES4)} AS route, cohort_month,
  epoch_ms(o_orderdate) AS received_at, epoch_ms(o_orderdate)+90*{DAY} AS due_at,
  CASE WHEN o_orderstatus='F' THEN epoch_ms(o_orderdate)+CAST(floor(o_totalprice) AS BIGINT)%150*{DAY} END AS completed_at,
  CASE WHEN o_orderstatus='F' THEN epoch_ms(o_orderdate)+CAST(floor(o_totalprice) AS BIGINT)%150*{DAY}
   ELSE epoch_ms(o_orderdate) END AS updated_at,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'IN_REVIEW' ELSE 'RECEIVED' END AS status,
  CASE WHEN o_orderstatus='F' THEN 'APPROVED' END AS outcome,
  CASE WHEN o_orderstatus='F' THEN CAST(CAST(floor(o_totalprice) AS BIGINT)%150 AS DOUBLE)*0.6e0 ELSE 0e0 END AS touch_days,
  CASE WHEN o_orderstatus='F' THEN CAST(CAST(floor(o_totalprice) AS BIGINT)%150 AS DOUBLE)*0.4e0 ELSE 0e0 END AS wait_days,
  CAST(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 2 ELSE 1 END AS INT) AS revision
 FROM f_dossiers""",
    "f_enrichment": """SELECT CAST(c_custkey AS VARCHAR) AS entity_id,
  CASE WHEN c_custkey%20<>1 THEN c_name END AS legal_name, CASE WHEN c_custkey%20<>1 THEN n_name END AS country,
  CASE WHEN c_custkey%20<>1 THEN CASE WHEN c_acctbal<0 THEN 'high' WHEN c_acctbal<3000 THEN 'elevated'
   WHEN c_acctbal<7000 THEN 'standard' ELSE 'low' END END AS risk_tier,
  CASE WHEN c_custkey%20<>1 THEN CASE WHEN c_acctbal<0 THEN 'suspended' ELSE 'active' END END AS registry_status,
  c_custkey%250 AS source_latency_ms, CASE WHEN c_custkey%20<>1 THEN 'enriched' ELSE 'unavailable' END AS status
 FROM customer JOIN nation ON c_nationkey=n_nationkey WHERE c_custkey%10<>0""",
    "f_edges": """SELECT 'nation:'||n_nationkey AS src, 'region:'||n_regionkey AS dst, 'MEMBER_OF' AS type,
  'native-id' AS rule, 1.0e0 AS confidence FROM nation
 UNION ALL SELECT 'customer:'||c_custkey, 'nation:'||c_nationkey, 'MEMBER_OF', 'declared', 0.9e0 FROM customer
 UNION ALL SELECT 'order:'||o_orderkey, 'customer:'||o_custkey, 'DEPENDS_ON', 'convention', 0.6e0 FROM orders""",
    "f_resources": """SELECT 'region:'||r_regionkey AS urn, 'directory' AS provider, 'schema' AS kind, r_name AS name,
  'global' AS scope, CAST(NULL AS VARCHAR) AS owner, 'control-plane' AS environment, 'ok' AS status FROM region
 UNION ALL SELECT 'nation:'||n_nationkey,'directory','role',n_name,'region-'||n_regionkey,NULL,'control-plane','ok' FROM nation
 UNION ALL SELECT 'customer:'||c_custkey,'crm','group',c_name,'nation-'||c_nationkey,c_mktsegment,'production',
  CASE WHEN c_acctbal<0 THEN 'suspended' ELSE 'active' END FROM customer
 UNION ALL SELECT 'order:'||o_orderkey,'intake','table','order-'||o_orderkey,'default',NULL,'production',
  lower(o_orderstatus) FROM orders""",
    "f_audit": """SELECT CAST(event_id AS VARCHAR) AS query_id, CAST(user_id AS VARCHAR) AS username,
  CAST(user_id%7 AS VARCHAR) AS principal, CASE WHEN event_type='error' THEN 'FAILED' ELSE 'FINISHED' END AS state,
  CAST(floor(value*10) AS BIGINT) AS wall_ms, CAST(json_extract_string(props,'$.k') AS BIGINT) AS rows_returned,
  'lake.gold.'||event_type AS tables_accessed, strftime(ts,'%Y-%m-%d') AS audit_day FROM events""",
    "f_valid": f"SELECT * FROM f_activities WHERE {VALID}",
    "f_rules": "SELECT * FROM (" + values(
        (i.process, i.key, i.activity, i.aggregation, i.success, i.application_type, i.routes,
         i.baseline, i.target) for i in c.indicators())
    + ") AS r(process_code,kpi_id,activity_type,aggregation,success,rule_type,routes,baseline,target)",
    "f_measurements": f"""SELECT a.record_id||':'||r.kpi_id AS measurement_id, a.cohort_month, a.application_id,
  a.record_id AS activity_id, a.tenant_id, a.process_code, r.kpi_id, {qlabel('a.completed_at')} AS reporting_quarter,
  CASE WHEN r.aggregation='percentage' THEN CASE WHEN ok THEN 100e0 ELSE 0e0 END
   ELSE CAST(a.completed_at-a.received_at AS DOUBLE)/86400000e0 END AS measured_value,
  CASE WHEN ok THEN 1 ELSE 0 END AS numerator, 1 AS denominator, a.updated_at
 FROM f_valid a JOIN f_rules r ON a.process_code=r.process_code AND a.activity_type=r.activity_type
  AND (r.rule_type='' OR r.rule_type=a.application_type) AND (len(r.routes)=0 OR list_contains(r.routes,a.route)),
  LATERAL (SELECT CASE WHEN r.success='compliant' THEN coalesce(a.outcome='COMPLIANT',false)
    ELSE a.completed_at<=a.due_at END AS ok) s
 WHERE a.completed_at IS NOT NULL AND a.status='COMPLETED'""",
    "f_kpi": f"""SELECT m.tenant_id, m.process_code, m.kpi_id, m.reporting_quarter, r.baseline, r.target,
  CAST(sum(numerator) AS BIGINT) AS numerator, CAST(sum(denominator) AS BIGINT) AS denominator,
  max(updated_at) AS updated_at,
  CASE WHEN any_value(r.aggregation)='percentage' THEN 100e0*sum(numerator)/nullif(sum(denominator),0)
   WHEN any_value(r.aggregation)='average' THEN avg(measured_value)
   ELSE {_MEDIAN.format('measured_value')} END AS value
 FROM f_measurements m JOIN f_rules r ON m.process_code=r.process_code AND m.kpi_id=r.kpi_id
 GROUP BY m.tenant_id, m.process_code, m.kpi_id, m.reporting_quarter, r.baseline, r.target""",
    "f_points": f"""SELECT m.process_code, m.kpi_id, m.reporting_quarter, r.baseline, r.target,
  CAST(sum(numerator) AS BIGINT) AS numerator, CAST(sum(denominator) AS BIGINT) AS denominator,
  CASE WHEN any_value(r.aggregation)='percentage' THEN 100e0*sum(numerator)/nullif(sum(denominator),0)
   WHEN any_value(r.aggregation)='average' THEN avg(measured_value)
   ELSE {_MEDIAN.format('measured_value')} END AS value
 FROM f_measurements m JOIN f_rules r ON m.process_code=r.process_code AND m.kpi_id=r.kpi_id
 GROUP BY m.process_code, m.kpi_id, m.reporting_quarter, r.baseline, r.target""",
}

_NAME = re.compile(r"\b[a-z]_[a-z_0-9]+\b")


def register(name: str, sql: str) -> None:
    RELATIONS[name] = sql


def complete(body: str) -> str:
    """The body preceded by every relation it needs."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in RELATIONS and name not in order:
                visit(RELATIONS[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in order)
    keyword = "WITH RECURSIVE " if "RECURSIVE" in body else "WITH "
    stripped = body.strip()
    if stripped.upper().startswith("WITH"):
        stripped = "," + re.sub(r"(?i)^WITH(\s+RECURSIVE)?", "", stripped, count=1)
    return f"{keyword}{head}\n{stripped}"
