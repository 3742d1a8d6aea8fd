"""The declared contract: sizes, inheritance and literal expectations."""
from __future__ import annotations

from regulus import contract as c
from regulus.operators import semantic


def test_indicators():
    rules = c.indicators()
    assert len(rules) == 43 and len({r.key for r in rules}) == 43
    by_key = {r.key: r for r in rules}
    child = by_key["pct_facilities_compliant_on_site_domestic"]
    assert (child.success, child.routes, child.target) == ("compliant", ("on_site_domestic",), 85.0)
    assert by_key["avg_turnaround_time_gmp_on_site_foreign"].aggregation == "average"
    assert by_key["median_turnaround_time_on_site_domestic"].baseline == 65.0
    assert by_key["pct_new_apps_evaluated_on_time_ct"].process == "CT"
    assert by_key["pct_gcp_compliant"].success == "compliant"
    assert by_key["pct_capa_decisions_on_time_reliance_rec_joint_inspections"].routes == c.ROUTES[2:]


def test_metrics():
    assert len(semantic.metric_names()) == 19
    assert semantic.resolve("quality_metrics_compliance_rate")[1] == "compliance_rate"


def test_every_column_is_classified():
    assert set(c.FACT_COLUMNS) == set(c.FACT_CLASSIFICATION)
    assert set(c.ENRICHMENT_SCHEMA.fieldNames()) == set(c.ENRICHMENT_CLASSIFICATION)
    assert len(c.FACT_COLUMNS) == 18
