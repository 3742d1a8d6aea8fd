"""Declared metrics over the marts and the query builder that evaluates them."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regulus.functions.columns import percent


@dataclass(frozen=True)
class Model:
    """A mart with its dimensions, time dimension and measures (name -> aggregation)."""

    name: str
    time: str
    dimensions: tuple[str, ...]
    measures: dict[str, str]
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)


MODELS = {m.name: m for m in (
    Model("application_throughput", "arrival_date",
          ("process", "application_type", "handling_route"),
          {"applications_received": "sum", "applications_completed": "sum",
           "applications_open": "sum", "applications_overdue": "sum"},
          {"completion_rate": ("applications_completed", "applications_received")}),
    Model("turnaround_performance", "arrival_date", ("process", "activity", "handling_route"),
          {"avg_turnaround_days": "average", "median_turnaround_days": "median",
           "avg_working_days": "average", "avg_waiting_days": "average",
           "pct_on_time": "average"}),
    Model("delay_analysis", "arrival_date", ("process", "workflow_stage"),
          {"avg_elapsed_days": "average", "avg_waiting_days": "average",
           "pct_time_waiting": "average", "times_performed": "sum"}),
    Model("quality_metrics", "arrival_date", ("process", "activity", "handling_route"),
          {"pct_compliant": "average", "compliant_count": "sum", "non_compliant_count": "sum",
           "assessments": "sum"},
          {"compliance_rate": ("compliant_count", "assessments")}),
    Model("indicator_performance", "quarter_start", ("process", "indicator", "target_status"),
          {"indicator_value": "average", "indicator_target": "average"}),
)}


def metric_names() -> list[str]:
    return [f"{m.name}_{measure}" for m in MODELS.values() for measure in m.measures]


def resolve(metric: str) -> tuple[Model, str]:
    for model in sorted(MODELS.values(), key=lambda m: -len(m.name)):
        measure = metric.removeprefix(f"{model.name}_")
        if measure != metric and (measure in model.measures or measure in model.ratios):
            return model, measure
    raise KeyError(f"no such metric: {metric}")


def _aggregate(model: Model, measure: str) -> Column:
    if measure in model.ratios:
        numerator, denominator = model.ratios[measure]
        return percent(F.sum(numerator), F.sum(denominator))
    kind = model.measures[measure]
    return {"sum": F.sum, "average": F.avg, "median": F.median}[kind](measure)


def metric_query(marts: dict[str, DataFrame], metrics: list[str], by: list[str],
                 grain: str | None = None) -> DataFrame:
    """Metrics of one model by its dimensions; ``metric_time`` is truncated to ``grain``.

    The marts are already reduced to their dimensions, so the groups here stay small.
    """
    pairs = [resolve(m) for m in metrics]
    model = pairs[0][0]
    if any(p[0] is not model for p in pairs):
        raise ValueError("metrics of one query belong to one model")
    unknown = set(by) - {*model.dimensions, "metric_time"}
    if unknown:
        raise KeyError(f"not a dimension of {model.name}: {sorted(unknown)}")
    keys = [F.trunc(model.time, grain or "month").alias("metric_time") if d == "metric_time"
            else F.col(d) for d in by]
    return marts[model.name].groupBy(*keys).agg(
        *[_aggregate(model, measure).alias(name) for name, (_, measure) in zip(metrics, pairs)])
