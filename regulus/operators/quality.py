"""Validation, constraint audits and reconciliation."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regulus import contract as c


def validity() -> Column:
    """The published validity rule of a fact. Null where an operand of a comparison is null."""
    f = F.col
    return (f("record_id").isNotNull() & f("tenant_id").isNotNull() & f("cohort_month").isNotNull()
            & f("received_at").isNotNull() & (f("due_at") >= f("received_at"))
            & (f("completed_at").isNull() | (f("completed_at") >= f("received_at")))
            & (f("touch_days") >= 0) & (f("wait_days") >= 0) & (f("revision") > 0))


def is_valid() -> Column:
    """Two-valued form: a fact whose rule cannot be decided is not valid, so none disappears."""
    return F.coalesce(validity(), F.lit(False))


def valid(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def quarantine(df: DataFrame) -> DataFrame:
    return df.filter(~is_valid())


def constraint_violations(df: DataFrame) -> DataFrame:
    """Each fact that breaks a source constraint, with the names of the broken ones."""
    f = F.col

    def broken(name: str, ok: Column) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), name)

    checks = F.array_compact(F.array(
        broken("process", f("process_code").isin(*c.PROCESSES)),
        broken("dates", (f("due_at") >= f("received_at"))
               & (f("completed_at").isNull() | (f("completed_at") >= f("received_at")))),
        broken("measures", (f("touch_days") >= 0) & (f("wait_days") >= 0) & (f("revision") > 0)),
        broken("status", f("status").isin(*c.STATUSES))))
    return df.withColumn("violations", checks).filter(F.size("violations") > 0)


def moved_identities(history: DataFrame) -> DataFrame:
    """Keys whose application or cohort changed over their revisions; both are immutable."""
    return (history.groupBy("record_id")
            .agg(F.min("application_id").alias("a0"), F.max("application_id").alias("a1"),
                 F.min("cohort_month").alias("c0"), F.max("cohort_month").alias("c1"))
            .filter((F.col("a0") != F.col("a1")) | (F.col("c0") != F.col("c1")))
            .select("record_id"))


def orphans(children: DataFrame, applications: DataFrame) -> DataFrame:
    """Child facts without their application."""
    parents = applications.select(F.col("record_id").alias("application_id")).distinct()
    return children.join(parents, "application_id", "left_anti")


def multiset_difference(expected: DataFrame, actual: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose number of copies differs, with both counts; empty means equal multisets.

    Copies are counted per side before the shuffle, and the two sides meet in one aggregate.
    """
    both = (expected.select(*columns, F.lit(1).alias("_e"), F.lit(0).alias("_a"))
            .unionByName(actual.select(*columns, F.lit(0).alias("_e"), F.lit(1).alias("_a"))))
    return (both.groupBy(*columns).agg(F.sum("_e").alias("expected_copies"),
                                       F.sum("_a").alias("actual_copies"))
            .filter(F.col("expected_copies") != F.col("actual_copies")))


def _row_hashes(df: DataFrame, columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row that tell nulls, and the places of equal values, apart; zeros of either sign are equal."""
    parts = []
    for name, kind in df.select(*columns).dtypes:
        value = F.col(name)
        parts += [value.isNull(), F.when(value == 0, F.lit(0).cast(kind)).otherwise(value) if kind in ("double", "float") else value]
    return [F.xxhash64(F.lit(mark), *parts) for mark in ("first", "second")]


def fingerprints(df: DataFrame, cohort: str, columns: list[str]) -> DataFrame:
    """(cohort, rows, first, second): what equal multisets of rows have in common, whatever their order.

    A fingerprint is the number of rows and the sums of two hashes of each, so tasks add up their own rows and one row per cohort
    moves. Different multisets agree by chance only, with odds of about one in 2^128.
    """
    first, second = (F.sum(h.cast("decimal(20,0)")) for h in _row_hashes(df, columns))
    return df.groupBy(F.col(cohort).alias("cohort")).agg(F.count(F.lit(1)).alias("rows"), first.alias("first"), second.alias("second"))


def differing_cohorts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The cohorts whose fingerprints differ, those that one side lacks included."""
    e, a = (side.select("cohort", F.struct("rows", "first", "second").alias(name)) for side, name in ((expected, "e"), (actual, "a")))
    both = e.join(a, e["cohort"].eqNullSafe(a["cohort"]), "full").select(F.coalesce(e["cohort"], a["cohort"]).alias("cohort"), "e", "a")
    return both.filter(~F.col("e").eqNullSafe(F.col("a"))).select("cohort")


#: Differing cohorts up to which they are named in the scans' filters; more of them are joined.
MOST_NAMED = 1000


def reconcile(expected: DataFrame, actual: DataFrame, cohort: str, columns: list[str],
              fingerprints_of: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Rows whose number of copies differs, with both counts; only rows of cohorts with different fingerprints are compared.

    Where a table is partitioned by cohort, the others are not even read in the comparison. ``fingerprints_of`` takes fingerprints that
    are stored with the tables; they must be of these columns. Columns of one name must have one type on both sides.
    """
    kinds = [dict(df.select(cohort, *columns).dtypes) for df in (expected, actual)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"types differ: {sorted(set(kinds[0].items()) ^ set(kinds[1].items()))}")
    stored = fingerprints_of or tuple(fingerprints(df, cohort, columns) for df in (expected, actual))
    cohorts = differing_cohorts(*stored)
    named = [r["cohort"] for r in cohorts.limit(MOST_NAMED + 1).collect()]
    if len(named) > MOST_NAMED:
        sides = [df.join(cohorts.withColumnRenamed("cohort", "_c"), df[cohort].eqNullSafe(F.col("_c")), "left_semi") for df in (expected, actual)]
    else:
        wanted = F.col(cohort).isin([n for n in named if n is not None])
        wanted = wanted | F.col(cohort).isNull() if None in named else wanted
        sides = [df.filter(wanted) for df in (expected, actual)]
    return multiset_difference(*sides, [cohort, *[n for n in columns if n != cohort]])


def submission_reasons() -> Column:
    """Why an intake row is refused; an empty array means accepted."""
    f = F.col
    known_type = reduce(lambda a, b: a | b, [
        (f("process_code") == p) & f("application_type").isin(*types)
        for p, types in c.APPLICATION_TYPES.items()])

    def reason(name: str, ok: Column) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), name)

    return F.array_compact(F.array(
        reason("process", f("process_code").isin(*c.PROCESSES)),
        reason("application_type", known_type),
        reason("route", f("route").isin(*c.ROUTES)),
        reason("application_id", f("application_id").rlike(c.APPLICATION_ID_PATTERN)),
        reason("tenant_id", f("tenant_id").rlike(c.TENANT_PATTERN))))


def validate_submissions(intake: DataFrame) -> DataFrame:
    return intake.withColumn("reasons", submission_reasons())


def first_claims(intake: DataFrame, registry: DataFrame) -> DataFrame:
    """Accepted submissions whose id is not taken, one per id: the earliest received wins.

    Identifiers are unique across every process, so the registry spans them all.
    """
    accepted = validate_submissions(intake).filter(F.size("reasons") == 0).drop("reasons")
    fresh = accepted.join(registry.select("application_id").distinct(), "application_id", "left_anti")
    rest = [n for n in fresh.columns if n != "application_id"]
    return (fresh.groupBy("application_id")
            .agg(F.min_by(F.struct(*rest), F.struct("received_at", "process_code", "entity_id",
                                                    "application_type", "route", "tenant_id"))
                 .alias("_s")).select("application_id", "_s.*"))


def intake_facts(accepted: DataFrame) -> DataFrame:
    """The fact row of an accepted submission."""
    received = F.col("received_at")
    due = F.unix_millis(F.timestamp_millis(received)
                        + F.make_dt_interval(F.lit(c.SUBMISSION_SLA_DAYS)))
    return accepted.select(
        F.col("application_id").alias("record_id"), "application_id", "tenant_id", "entity_id",
        "process_code", "application_type", F.lit("application").alias("activity_type"), "route",
        F.date_format(F.timestamp_millis(received), "yyyy-MM").alias("cohort_month"),
        received.alias("received_at"), due.alias("due_at"),
        F.lit(None).cast("bigint").alias("completed_at"), received.alias("updated_at"),
        F.lit("RECEIVED").alias("status"), F.lit(None).cast("string").alias("outcome"),
        F.lit(0.0).alias("touch_days"), F.lit(0.0).alias("wait_days"), F.lit(1).alias("revision"))


def repeated_ids(relations: list[DataFrame]) -> DataFrame:
    """Identifiers used more than once over several relations."""
    ids = [r.select("application_id", "process_code") for r in relations]
    return (reduce(DataFrame.unionByName, ids).groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("uses"),
                 F.array_sort(F.collect_set("process_code")).alias("processes"))
            .filter("uses > 1"))


def count_issues(kpi: DataFrame) -> DataFrame:
    """How many indicator rows break each bound of their counts."""
    n, d = F.col("numerator"), F.col("denominator")
    return kpi.agg(
        F.count_if(n > d).alias("numerator_exceeds_denominator"),
        F.count_if(n < 0).alias("negative_numerator"),
        F.count_if(d <= 0).alias("empty_denominator"))


def published_disagreements(published: DataFrame, counts: DataFrame,
                            tolerance: float = 0.01) -> DataFrame:
    """Published percentages against their counts: impossible counts and differing values."""
    keys = ["process_code", "kpi_id", "reporting_quarter"]
    n, d, v = F.col("numerator"), F.col("denominator"), F.col("published")
    share = n.cast("double") / F.nullif(d, F.lit(0)).cast("double") * 100
    too_many = counts.filter(n > d).select(
        *keys, F.lit("numerator_exceeds_denominator").alias("kind"), n, d)
    differs = (counts.join(published.select(*keys, "published"), keys)
               .filter((d > 0) & (F.abs(share - v) > tolerance))
               .select(*keys, F.lit("percentage_disagrees_with_counts").alias("kind"), n, d))
    return too_many.unionByName(differs)


def negative_values(long_form: DataFrame) -> DataFrame:
    """Negative measures anywhere in a long-form section, with their path."""
    return long_form.filter(F.col("value") < 0).select(
        F.concat_ws(".", "section", "process", "name", "quarter", "measure").alias("path"), "value")
