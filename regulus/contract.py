"""The business contract: processes, indicators, targets, schemas and access declarations.

Every table here is a fixed value of the domain and has a fixed, small size; these are the only
relations the code broadcasts by hint.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import types as T

# ---- fixed values: processes, routes, statuses -------------------------------------------------
PROCESSES = ("MA", "CT", "GMP")
FAMILIES = ("applications", "activities", "steps")
ROUTES = (
    "on_site_domestic",
    "on_site_foreign",
    "reliance_joint_on_site_foreign",
    "reliance_joint_desk_based_foreign",
)
STATUSES = ("RECEIVED", "IN_REVIEW", "COMPLETED", "CANCELLED")
APPLICATION_TYPES = {
    "MA": ("new", "renewal", "variation"),
    "CT": ("new", "amendment"),
    "GMP": ("inspection",),
}
SUBMISSION_SLA_DAYS = 90
APPLICATION_ID_PATTERN = "^[A-Za-z0-9:_-]{8,64}$"
TENANT_PATTERN = "^[a-z][a-z0-9_]{1,62}$"

DAY_MS = 86_400_000


@dataclass(frozen=True)
class Indicator:
    """One published indicator: which activities it measures and what it is compared with."""

    key: str
    process: str
    activity: str
    aggregation: str
    success: str
    application_type: str
    routes: tuple[str, ...]
    sla_days: int
    baseline: float
    target: float


# ---- fixed values: (indicator, activity, application type, SLA days, baseline, target) ----------
BASE_INDICATORS = {
    "MA": (
        ("pct_new_apps_evaluated_on_time", "evaluation", "new", 90, 65, 90),
        ("pct_renewal_apps_evaluated_on_time", "evaluation", "renewal", 60, 70, 90),
        ("pct_variation_apps_evaluated_on_time", "evaluation", "variation", 30, 60, 85),
        ("pct_fir_responses_on_time", "fir_response", "", 30, 55, 75),
        ("pct_query_responses_evaluated_on_time", "query_response", "", 30, 80, 90),
        ("pct_granted_within_90_days", "decision", "", 90, 40, 60),
        ("median_duration_continental", "decision", "", 90, 120, 90),
    ),
    "CT": (
        ("pct_new_apps_evaluated_on_time_ct", "evaluation", "new", 60, 75, 85),
        ("pct_amendment_apps_evaluated_on_time", "evaluation", "amendment", 30, 70, 80),
        ("pct_gcp_inspections_on_time", "inspection", "", 30, 60, 75),
        ("pct_safety_reports_assessed_on_time", "safety_report", "", 15, 85, 95),
        ("pct_gcp_compliant", "inspection", "", 30, 80, 90),
        ("pct_registry_submissions_on_time", "registration", "", 30, 90, 100),
        ("pct_capa_evaluated_on_time", "capa", "", 30, 65, 80),
        ("avg_turnaround_time", "decision", "", 60, 50, 30),
    ),
    "GMP": (
        ("pct_inspections_waived_on_time", "waiver", "", 30, 75, 90),
        ("pct_facilities_inspected_on_time", "inspection", "", 60, 70, 85),
        ("pct_facilities_compliant", "inspection", "", 60, 75, 85),
        ("pct_capa_decisions_on_time", "capa", "", 30, 70, 80),
        ("pct_applications_completed_on_time", "decision", "", 90, 80, 90),
        ("avg_turnaround_time_gmp", "decision", "", 90, 70, 45),
        ("median_turnaround_time", "decision", "", 90, 65, 40),
        ("pct_reports_published_on_time", "report", "", 15, 65, 80),
    ),
}

# ---- fixed values: which routes a disaggregated child covers ------------------------------------
SUFFIX_ROUTES = {
    "on_site_domestic": ("on_site_domestic",),
    "on_site_foreign": ("on_site_foreign",),
    "reliance_joint_on_site_foreign": ("reliance_joint_on_site_foreign",),
    "reliance_joint_desk_based_foreign": ("reliance_joint_desk_based_foreign",),
    "direct_foreign_domestic_done_by_nra": ("on_site_domestic", "on_site_foreign"),
    "reliance_rec_joint_inspections": (
        "reliance_joint_on_site_foreign",
        "reliance_joint_desk_based_foreign",
    ),
    "domestic_applicant": ("on_site_domestic",),
    "foreign_applicant_direct": ("on_site_foreign",),
    "foreign_applicant_reliance": (
        "reliance_joint_on_site_foreign",
        "reliance_joint_desk_based_foreign",
    ),
}

# ---- fixed values: base indicator -> {choice label: child suffix} -------------------------------
DISAGGREGATIONS = {
    "pct_facilities_inspected_on_time": {
        "On-site Domestic": "on_site_domestic",
        "On-site Foreign": "on_site_foreign",
        "Reliance/Joint On-site Foreign": "reliance_joint_on_site_foreign",
    },
    "pct_facilities_compliant": {
        "On-site Domestic": "on_site_domestic",
        "On-site Foreign": "on_site_foreign",
        "Reliance/Joint On-site Foreign": "reliance_joint_on_site_foreign",
        "Reliance/Joint Desk-based Foreign": "reliance_joint_desk_based_foreign",
    },
    "pct_capa_decisions_on_time": {
        "Direct NRA": "direct_foreign_domestic_done_by_nra",
        "Reliance Joint": "reliance_rec_joint_inspections",
    },
    "pct_applications_completed_on_time": {
        "Domestic Applicant": "domestic_applicant",
        "Foreign Direct": "foreign_applicant_direct",
        "Foreign Reliance": "foreign_applicant_reliance",
    },
    "avg_turnaround_time_gmp": {
        "On-site Domestic": "on_site_domestic",
        "On-site Foreign": "on_site_foreign",
        "Reliance/Joint On-site Foreign": "reliance_joint_on_site_foreign",
    },
    "median_turnaround_time": {
        "On-site Domestic": "on_site_domestic",
        "On-site Foreign": "on_site_foreign",
    },
    "pct_reports_published_on_time": {
        "On-site Domestic": "on_site_domestic",
        "On-site Foreign": "on_site_foreign",
        "Reliance/Joint On-site Foreign": "reliance_joint_on_site_foreign",
    },
}

# ---- fixed values: step-name endings of disaggregated steps, tried in this order ----------------
STEP_SUFFIXES = (
    "_domestic",
    "_foreign",
    "_reliance_joint_on_site_foreign",
    "_reliance_joint_desk_based_foreign",
    "_direct_foreign_domestic_done_by_nra",
    "_reliance_rec_joint_inspections",
    "_domestic_applicant",
    "_foreign_applicant_direct",
    "_foreign_applicant_reliance",
)

# ---- fixed values: the workflow steps that explain an indicator ---------------------------------
INDICATOR_STEPS = {
    "MA": {
        "pct_new_apps_evaluated_on_time": (
            "Preliminary Screening", "Technical Dossier Review", "Quality Review",
            "Safety & Efficacy Review", "Queries to Applicant", "Applicant Response Review",
            "Decision Issued", "License Publication"),
        "pct_renewal_apps_evaluated_on_time": (
            "Preliminary Screening", "Technical Dossier Review", "Decision Issued"),
        "pct_variation_apps_evaluated_on_time": (
            "Preliminary Screening", "Technical Dossier Review", "Decision Issued"),
        "pct_fir_responses_on_time": ("Queries to Applicant",),
        "pct_query_responses_evaluated_on_time": ("Applicant Response Review",),
        "pct_granted_within_90_days": (
            "Technical Dossier Review", "Queries to Applicant", "Applicant Response Review",
            "Decision Issued"),
        "median_duration_continental": (
            "Preliminary Screening", "Technical Dossier Review", "Quality Review",
            "Safety & Efficacy Review", "Queries to Applicant", "Applicant Response Review",
            "Decision Issued", "License Publication"),
    },
    "CT": {
        "pct_new_apps_evaluated_on_time_ct": (
            "Administrative Screening", "Ethics Review", "Technical Review", "GCP Inspection",
            "Applicant Response Review", "Decision Issued", "Trial Registration"),
        "pct_amendment_apps_evaluated_on_time": (
            "Administrative Screening", "Technical Review", "Decision Issued"),
        "pct_gcp_inspections_on_time": ("GCP Inspection",),
        "pct_safety_reports_assessed_on_time": ("Technical Review",),
        "pct_gcp_compliant": ("GCP Inspection",),
        "pct_registry_submissions_on_time": ("Trial Registration",),
        "pct_capa_evaluated_on_time": ("Applicant Response Review",),
        "avg_turnaround_time": (
            "Administrative Screening", "Ethics Review", "Technical Review", "GCP Inspection",
            "Applicant Response Review", "Decision Issued"),
    },
    "GMP": {
        "pct_facilities_inspected_on_time": (
            "Inspection Planning", "Inspection Conducted", "Inspection Report Drafted"),
        "pct_inspections_waived_on_time": ("Inspection Planning",),
        "pct_facilities_compliant": (
            "Inspection Conducted", "CAPA Review", "Final Decision Issued"),
        "pct_capa_decisions_on_time": (
            "CAPA Requested", "CAPA Review", "Final Decision Issued"),
        "pct_applications_completed_on_time": (
            "Application Screening", "Inspection Planning", "Inspection Conducted",
            "Final Decision Issued"),
        "avg_turnaround_time_gmp": (
            "Application Screening", "Inspection Planning", "Inspection Conducted",
            "Inspection Report Drafted", "CAPA Requested", "CAPA Review",
            "Final Decision Issued", "Report Publication"),
        "median_turnaround_time": (
            "Application Screening", "Inspection Planning", "Inspection Conducted",
            "Inspection Report Drafted", "CAPA Requested", "CAPA Review",
            "Final Decision Issued", "Report Publication"),
        "pct_reports_published_on_time": ("Report Publication",),
    },
}

# ---- fixed values: activity -> (volume counted at receipt, volume counted at completion) --------
ACTIVITY_VOLUMES = {
    "MA": {
        "fir_response": ("fir_sent", "fir_responses_received"),
        "query_response": ("query_cycles_total", None),
        "decision": (None, "approvals_granted"),
    },
    "CT": {
        "inspection": ("gcp_inspections_requested", "gcp_inspections_conducted"),
        "registration": (None, "trials_registered"),
        "safety_report": ("safety_reports_submitted", None),
        "capa": ("capa_requests", None),
    },
    "GMP": {
        "inspection": ("inspections_requested_total", "inspections_conducted_total"),
        "capa": ("capas_requested", "capas_closed"),
        "report": (None, "reports_published"),
    },
}
TYPE_VOLUMES = {
    "MA": {"new": "new_applications", "renewal": "renewal_applications",
           "variation": "variation_applications"},
    "CT": {"new": "new_ct_applications", "amendment": "amendment_applications"},
}
GMP_ROUTE_VOLUMES = {
    "desk": "desk_based_inspections",
    "reliance": "inspections_reliance_joint",
    "domestic": "inspections_domestic",
    "foreign": "inspections_foreign",
}
BOTTLENECK_METRICS = (
    "cycle_time_median",
    "ext_median_days",
    "opening_backlog",
    "carry_over_rate",
    "avg_query_cycles",
    "fpy_pct",
    "wait_share_pct",
    "work_to_staff_ratio",
    "sched_median_days",
)

# ---- fixed values: classification (class, lawful basis, needs masking) and retention days -------
FACT_CLASSIFICATION = {
    "record_id": ("indirect_identifier", "legal_obligation", False),
    "application_id": ("indirect_identifier", "legal_obligation", False),
    "tenant_id": ("access_control_identifier", "legal_obligation", False),
    "entity_id": ("pseudonymous_identifier", "legal_obligation", True),
    "process_code": ("operational", "legal_obligation", False),
    "application_type": ("operational", "legal_obligation", False),
    "activity_type": ("operational", "legal_obligation", False),
    "route": ("operational", "legal_obligation", False),
    "cohort_month": ("operational", "legal_obligation", False),
    "received_at": ("operational", "legal_obligation", False),
    "due_at": ("operational", "legal_obligation", False),
    "completed_at": ("operational", "legal_obligation", False),
    "updated_at": ("operational", "legal_obligation", False),
    "status": ("operational", "legal_obligation", False),
    "outcome": ("regulatory_decision", "legal_obligation", False),
    "touch_days": ("operational", "legal_obligation", False),
    "wait_days": ("operational", "legal_obligation", False),
    "revision": ("technical", "legal_obligation", False),
}
ENRICHMENT_CLASSIFICATION = {
    "entity_id": ("pseudonymous_identifier", "legal_obligation", True),
    "legal_name": ("direct_identifier", "legitimate_interest", True),
    "country": ("location", "legitimate_interest", True),
    "risk_tier": ("derived_assessment", "legitimate_interest", False),
    "registry_status": ("derived_assessment", "legitimate_interest", False),
    "enriched_at": ("technical", "legitimate_interest", False),
    "source_latency_ms": ("technical", "legitimate_interest", False),
    "status": ("technical", "legitimate_interest", False),
}
RETENTION_DAYS = {"bronze": 30, "silver": 730, "gold": 2555}
RETENTION_FLOOR_DAYS = 7
SECRET_KEY_PARTS = ("password", "secret", "token", "private_key", "credential")

# ---- fixed values: product -> roles that may read it; absent means denied -----------------------
PRODUCT_AUDIENCE = {
    "application_throughput": (
        "business_user", "analyst", "data_scientist", "data_engineer", "administrator"),
    "turnaround_performance": (
        "business_user", "analyst", "data_scientist", "data_engineer", "administrator"),
    "delay_analysis": (
        "business_user", "analyst", "data_scientist", "data_engineer", "administrator"),
    "indicator_performance": (
        "business_user", "analyst", "data_scientist", "data_engineer", "administrator"),
    "quality_metrics": ("analyst", "data_scientist", "data_engineer", "administrator"),
}
ROLES = ("business_user", "analyst", "data_scientist", "data_engineer", "administrator")

# ---- fixed values: group -> (processes, layers, formats, indicators, full dashboard, row limit) --
_ALL = ("MA", "CT", "GMP")
ENTITLEMENTS = {
    "ct-analysts": (("CT",), ("silver", "gold"), ("csv", "xlsx"), ("*",), False, 250_000),
    "data-engineering": (_ALL, ("bronze", "silver", "gold"), ("csv", "xlsx"), ("*",), True, 1_000_000),
    "data-science": (_ALL, ("silver", "gold"), ("csv", "xlsx"), ("*",), True, 500_000),
    "executive": (_ALL, (), (), ("*",), True, 0),
    "gmp-analysts": (("GMP",), ("silver", "gold"), ("csv", "xlsx"), ("*",), False, 250_000),
    "ma-analysts": (("MA",), ("silver", "gold"), ("csv", "xlsx"), ("*",), False, 250_000),
    "platform-services": (_ALL, ("bronze", "silver", "gold"), ("csv", "xlsx"), ("*",), True, 1_000_000),
    "public": (_ALL, (), (), (
        "pct_new_apps_evaluated_on_time", "pct_granted_within_90_days",
        "pct_new_apps_evaluated_on_time_ct", "pct_registry_submissions_on_time",
        "pct_facilities_inspected_on_time", "pct_reports_published_on_time"), False, 0),
}

# ---- fixed values: confidence of a resolved relation, by rule -----------------------------------
CONFIDENCE = {"native-id": 1.0, "declared": 0.9, "convention": 0.6, "state-file": 1.0,
              "tfstate-dependencies": 1.0, "declared-filename": 0.6}


class Managed(NamedTuple):
    """Which attribute of a state resource names the runtime object it manages."""
    type_pattern: str
    provider: str
    kind: str | None  # None: what the type says
    attribute: str
    scope: str = "default"
    nested: bool = False
    rule: str = "declared"


# Published types and attributes. The scope of the identity objects is a neutral name of our own.
MANAGED = (
    Managed("^keycloak_group$", "keycloak", "group", "name", "internal"),
    Managed("^keycloak_user$", "keycloak", "user", "username", "internal"),
    Managed("^keycloak_openid_client$", "keycloak", "client", "client_id", "internal"),
    Managed("^keycloak_role$", "keycloak", "role", "name", "internal"),
    Managed("^keycloak_realm$", "keycloak", "realm", "realm", "internal"),
    Managed("^kubernetes_", "kubernetes", None, "metadata", nested=True),
    Managed("bucket", "minio", "bucket", "bucket"),
    Managed("bucket", "minio", "bucket", "name"),
    Managed("^local_(sensitive_)?file$", "file", "config", "filename", "generated", rule="declared-filename"))
LOW_CONFIDENCE = 0.8
GRANT_KINDS = ("role", "data_product", "access_rule", "schema", "table", "view")
STAGE_LADDER = ("ephemeral", "staging", "production")


def _aggregation(key: str) -> str:
    if key.startswith("median_"):
        return "median"
    return "average" if key.startswith("avg_") else "percentage"


def indicators() -> list[Indicator]:
    """All 43 indicators: every base followed by its route-restricted children."""
    result = []
    for process, definitions in BASE_INDICATORS.items():
        for key, activity, app_type, sla, baseline, target in definitions:
            suffixes = DISAGGREGATIONS.get(key, {}).values() if process == "GMP" else ()
            for name, routes in [(key, ())] + [
                (f"{key}_{suffix}", SUFFIX_ROUTES[suffix]) for suffix in suffixes
            ]:
                result.append(Indicator(
                    name, process, activity, _aggregation(key),
                    "compliant" if "compliant" in key else "on_time",
                    app_type, routes, sla, float(baseline), float(target)))
    return result


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
          "double": T.DoubleType(), "timestamp": T.TimestampType()}


def _schema(spec: str) -> T.StructType:
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


FACT_SCHEMA = _schema(
    "record_id string, application_id string, tenant_id string, entity_id string, "
    "process_code string, application_type string, activity_type string, route string, "
    "cohort_month string, received_at bigint, due_at bigint, completed_at bigint, "
    "updated_at bigint, status string, outcome string, touch_days double, wait_days double, "
    "revision int")
FACT_COLUMNS = tuple(FACT_SCHEMA.fieldNames())

MEASUREMENT_SCHEMA = _schema(
    "measurement_id string, cohort_month string, application_id string, activity_id string, "
    "tenant_id string, process_code string, kpi_id string, reporting_quarter string, "
    "measured_value double, numerator int, denominator int, updated_at bigint")
MEASUREMENT_COLUMNS = tuple(MEASUREMENT_SCHEMA.fieldNames())

ENRICHMENT_SCHEMA = _schema(
    "entity_id string, legal_name string, country string, risk_tier string, "
    "registry_status string, enriched_at timestamp, source_latency_ms bigint, status string")

AUDIT_SCHEMA = _schema(
    "query_id string, event_time string, username string, principal string, source string, "
    "catalog_name string, schema_name string, query_text string, state string, "
    "error_code string, cpu_ms bigint, wall_ms bigint, rows_returned bigint, "
    "bytes_scanned bigint, tables_accessed string, audit_day string")

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("before", FACT_SCHEMA),
    T.StructField("after", FACT_SCHEMA),
    T.StructField("op", T.StringType()),
])
