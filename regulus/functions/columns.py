"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regulus.contract import DAY_MS, STEP_SUFFIXES


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- time ---------------------------------------------------------------------------------------
def epoch_ms(ts: str | Column) -> Column:
    """Epoch milliseconds of a timestamp, also for the zone-less Parquet type."""
    return F.unix_millis(col(ts).cast("timestamp"))


def at(ms: str | Column) -> Column:
    return F.timestamp_millis(col(ms))


def quarter_label(ms: str | Column) -> Column:
    """``Q3 2026`` for an epoch-millisecond column; null stays null."""
    t = at(ms)
    return F.concat(F.lit("Q"), F.quarter(t).cast("string"), F.lit(" "), F.year(t).cast("string"))


def quarter_index(label: str | Column) -> Column:
    """``year * 4 + quarter - 1``: the chronological order of quarter labels."""
    c = col(label)
    return (F.substring(c, 4, 4).cast("int") * 4 + F.substring(c, 2, 1).cast("int") - 1)


def quarter_index_of(ms: str | Column) -> Column:
    t = at(ms)
    return F.year(t) * 4 + F.quarter(t) - 1


def label_of_index(index: str | Column) -> Column:
    c = col(index)
    return F.concat(F.lit("Q"), (F.pmod(c, F.lit(4)) + 1).cast("string"), F.lit(" "),
                    F.floor(c / 4).cast("int").cast("string"))


def quarter_start(label: str | Column) -> Column:
    c = col(label)
    return F.make_date(F.substring(c, 4, 4).cast("int"),
                       (F.substring(c, 2, 1).cast("int") - 1) * 3 + 1, F.lit(1))


def month_start(month: str | Column) -> Column:
    return F.to_date(F.concat(col(month), F.lit("-01")))


def duration_days(start: str | Column, end: str | Column) -> Column:
    """Fractional days between two epoch-millisecond columns."""
    return (col(end) - col(start)).cast("double") / F.lit(float(DAY_MS))


def whole_days(start: str | Column, end: str | Column) -> Column:
    """Complete 24-hour periods between two instants, counted on whole seconds.

    Both operands lose their milliseconds before the difference is taken, so 23:59:59.900 to the
    next day 23:59:59.100 is one whole day.
    """
    seconds = F.floor(col(end) / 1000) - F.floor(col(start) / 1000)
    return F.when(seconds >= 0, F.floor(seconds / 86400)).otherwise(
        F.ceil(seconds / 86400)).cast("long")


# ---- numbers ------------------------------------------------------------------------------------
def rounded(c: str | Column, digits: int = 6) -> Column:
    """Half-up rounding after snapping to nine digits.

    The snap removes the last-bit noise of floating sums, whose order differs between runs; without
    it a value that sits exactly on a half could round either way.
    """
    return F.round(F.round(col(c), 9), digits)


def ratio(numerator: str | Column, denominator: str | Column, scale: float = 1.0) -> Column:
    """Double division; null when the denominator is zero or null."""
    d = col(denominator).cast("double")
    return F.lit(scale) * col(numerator).cast("double") / F.nullif(d, F.lit(0.0))


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    return ratio(numerator, denominator, 100.0)


# ---- indicators ---------------------------------------------------------------------------------
def lower_is_better(kpi: str | Column) -> Column:
    c = col(kpi)
    return c.startswith("avg_") | c.startswith("median_")


def target_status(kpi: str | Column, value: str | Column, target: str | Column) -> Column:
    v, t = col(value), col(target)
    met = F.when(lower_is_better(kpi), v <= t).otherwise(v >= t)
    return (F.when(t.isNull(), "No target").when(met, "Met target").otherwise("Below target"))


def light_status(kpi: str | Column, value: str | Column, target: str | Column) -> Column:
    """Traffic light of an indicator; the five per cent band is inclusive."""
    v, t = col(value), col(target)
    down = (F.when(v <= t, "success").when(v <= t * 1.05, "warning").otherwise("error"))
    up = (F.when(v >= t, "success").when(v >= t * 0.95, "warning").otherwise("error"))
    return (F.when(v.isNull() | t.isNull(), "unknown")
            .when(lower_is_better(kpi), down).otherwise(up))


def step_status(actual: str | Column, target: str | Column) -> Column:
    """Traffic light of a step; the five per cent band is exclusive, unlike for indicators."""
    a, t = col(actual), col(target)
    return F.when(a <= t, "success").when(a < t * 1.05, "warning").otherwise("error")


def met_target(kpi: str | Column, value: str | Column, target: str | Column) -> Column:
    v, t = col(value), col(target)
    return F.when(t.isNotNull(), F.when(lower_is_better(kpi), v <= t).otherwise(v >= t))


def shortfall(kpi: str | Column, value: str | Column, target: str | Column) -> Column:
    """Signed distance from target in the direction that means worse."""
    v, t = col(value), col(target)
    return rounded(F.when(lower_is_better(kpi), v - t).otherwise(t - v), 1)


def unit_of(kpi: str | Column) -> Column:
    return F.when(lower_is_better(kpi), "days").otherwise("%")


def route_class(route: str | Column) -> Column:
    r = col(route)
    return (F.when(r.contains("desk"), "desk").when(r.contains("reliance"), "reliance")
            .when(r.contains("domestic"), "domestic").otherwise("foreign"))


# ---- text ---------------------------------------------------------------------------------------
def masked(c: str | Column) -> Column:
    return F.concat(F.lit("sha256:"), F.upper(F.sha2(col(c), 256)))


def slug(c: str | Column) -> Column:
    """A safe identifier segment; empty input reads as ``unnamed``."""
    text = F.trim(F.coalesce(col(c).cast("string"), F.lit("")))
    cleaned = F.regexp_replace(text, r"[^A-Za-z0-9._@:/-]+", "-")
    stripped = F.regexp_replace(cleaned, r"^-+|-+$", "")
    return F.when(stripped == "", "unnamed").otherwise(stripped)


def sanitized(c: str | Column) -> Column:
    """Lower case with every run of other characters turned into one underscore."""
    return F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_")


def urn(provider: Column, kind: Column, scope: Column, name: Column) -> Column:
    return F.concat(F.lit("urn:infra:"), slug(provider), F.lit(":"), slug(kind), F.lit(":"),
                    slug(F.coalesce(scope, F.lit("default"))), F.lit("/"), slug(name))


# Fixed value: the URL namespace of name-based identifiers (RFC 4122, appendix C).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def name_uuid(c: str | Column) -> Column:
    """The version 5 identifier of a name in the URL namespace; equal names give equal ids."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), col(c).cast("binary")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"),
                    F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"),
                    F.substring(h, 21, 12))


def artifact_key(parts: str | Column) -> Column:
    """First twelve hex digits over the sorted ``k=v`` entries of a map column."""
    entries = F.transform(F.map_entries(col(parts)),
                          lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.substring(F.sha2(F.array_join(F.array_sort(entries), "|"), 256), 1, 12)


def is_disaggregated(step: str | Column) -> Column:
    c = col(step)
    hit = F.lit(False)
    for suffix in STEP_SUFFIXES:
        hit = hit | c.endswith(suffix)
    return hit


def base_step(step: str | Column) -> Column:
    """The step name without its route ending; the first ending in the list that fits wins."""
    c = col(step)
    result = F.when(F.lit(False), c)
    for suffix in STEP_SUFFIXES:
        result = result.when(c.endswith(suffix), F.substring(c, F.lit(1), F.length(c) - len(suffix)))
    return result.otherwise(c)


def last_token(c: str | Column) -> Column:
    """The part after the last underscore, or null when there is none."""
    return F.when(col(c).contains("_"), F.element_at(F.split(col(c), "_"), -1))


def progress(kpi: str | Column, value: str | Column, target: str | Column) -> Column:
    """Progress towards the target in per cent, capped at 100; nothing measured reads as 0."""
    v, t = col(value), col(target)
    share = F.when(lower_is_better(kpi), ratio(t, v, 100.0)).otherwise(ratio(v, t, 100.0))
    return F.when(v.isNull(), F.lit(0.0)).otherwise(F.least(F.lit(100.0), share))


def confidence_label(c: str | Column) -> Column:
    v = col(c)
    return (F.when(v.isNull() | (v >= 1.0), "Confirmed").when(v >= 0.85, "Declared")
            .otherwise("Likely"))


def with_default(c: str | Column, default: float = 0.0) -> Column:
    return F.coalesce(col(c), F.lit(default))
