"""Masking, redaction, entitlements, classification, retention, erasure and subject access."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regulus import contract as c
from regulus.functions.columns import masked
from regulus.operators.measurements import inline
from regulus.operators.quantiles import prefix_sums


# ---- masking ------------------------------------------------------------------------------------
def mask_facts(df: DataFrame) -> DataFrame:
    """The default analyst view: identifiers hashed, everything else as it is."""
    personal = {name for name, (_, _, mask) in c.FACT_CLASSIFICATION.items() if mask}
    return df.select(*[masked(n).alias(n) if n in personal else F.col(n) for n in df.columns])


def mask_enrichment(df: DataFrame) -> DataFrame:
    """Names and countries are emptied, the schema stays, the latency column is left out."""
    null = F.lit(None).cast("string")
    return df.select(masked("entity_id").alias("entity_id"), null.alias("legal_name"),
                     null.alias("country"), "risk_tier", "registry_status", "enriched_at", "status")


def redact_secrets(column: str | Column) -> Column:
    """Values of a map column whose key looks like a credential are replaced."""
    def secret(key: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.lower(key).contains(p) for p in c.SECRET_KEY_PARTS])
    return F.transform_values(column, lambda k, v: F.when(secret(k), "***redacted***").otherwise(v))


# ---- entitlements -------------------------------------------------------------------------------
def entitlements(spark: SparkSession) -> DataFrame:
    """The fixed group table."""
    return inline(spark, "group_name, processes, layers, formats, indicators, full_dashboard, row_limit",
                  [(g, *values) for g, values in c.ENTITLEMENTS.items()])


def effective_entitlements(memberships: DataFrame, group_table: DataFrame) -> DataFrame:
    """What each user may see: the union over the known groups.

    Unknown groups grant nothing. ``*`` among the indicators stands for all of them. A user whose
    groups are all unknown stays in the result with nothing granted. Memberships are first reduced
    to distinct pairs, so a user with many copies costs one.
    """
    pairs = memberships.select("user_name", "group_name").distinct()
    joined = pairs.join(F.broadcast(group_table), "group_name", "left")

    def union(name: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col(name)))))

    known = F.when(F.col("processes").isNotNull(), F.col("group_name"))
    grouped = joined.groupBy("user_name").agg(
        F.array_sort(F.collect_set(known)).alias("groups"),
        *[union(n).alias(n) for n in ("processes", "layers", "formats", "indicators")],
        F.coalesce(F.bool_or("full_dashboard"), F.lit(False)).alias("full_dashboard"),
        F.coalesce(F.max("row_limit"), F.lit(0)).alias("row_limit"))
    return (grouped.withColumn("indicators", F.when(
        F.array_contains("indicators", "*"), F.array(F.lit("*"))).otherwise(F.col("indicators")))
        .withColumn("can_export", F.size("layers") > 0))


def visible_points(points: DataFrame, group_table: DataFrame) -> DataFrame:
    """Indicator points as each group may see them.

    The group table has fixed size. It is exploded to (group, process) and broadcast; the indicator
    list is a residual test of that join.
    """
    allowed = F.broadcast(group_table.select(
        "group_name", "indicators", F.explode("processes").alias("process_code")))
    return points.join(allowed, "process_code").filter(
        F.array_contains("indicators", "*") | F.array_contains("indicators", F.col("kpi_id"))
    ).drop("indicators")


def visible_operations(rows: DataFrame, group_table: DataFrame) -> DataFrame:
    """Operational sections per group: blank without the full dashboard and without a row limit."""
    allowed = F.broadcast(group_table.filter(F.col("full_dashboard") | (F.col("row_limit") > 0))
                          .select("group_name", F.explode("processes").alias("process_code")))
    return rows.join(allowed, "process_code")


def process_of_table(table: str | Column) -> Column:
    """The process a physical table name belongs to, from its name parts."""
    parts = F.split(F.col(table) if isinstance(table, str) else table, "_")
    hits = F.array_intersect(parts, F.array(F.lit("ma"), F.lit("ct"), F.lit("gmp")))
    return F.upper(F.get(hits, F.lit(0)))


def export_decisions(requests: DataFrame, rights: DataFrame) -> DataFrame:
    """Allow a request when layer, format and the process of the table are all granted."""
    granted = requests.join(rights.select("user_name", "layers", "formats", "processes", "row_limit"),
                            "user_name", "left")
    process = process_of_table("table_name")
    allow = (F.array_contains("layers", F.col("layer"))
             & F.array_contains("formats", F.col("format"))
             & F.array_contains("processes", process))
    return granted.select(
        *requests.columns, F.coalesce(allow, F.lit(False)).alias("allow"),
        F.least(F.col("requested_rows"), F.coalesce("row_limit", F.lit(0)).cast("long"))
        .alias("row_cap"))


def product_audience(spark: SparkSession) -> DataFrame:
    return inline(spark, "product, role",
                  [(p, r) for p, roles in c.PRODUCT_AUDIENCE.items() for r in roles])


def readable_products(user_roles: DataFrame, audience: DataFrame) -> DataFrame:
    """(user, product) pairs the roles allow; no entry means denied."""
    return (user_roles.select("user_name", "role").distinct()
            .join(F.broadcast(audience), "role").select("user_name", "product").distinct())


def access_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Decisions that differ from the expectation, both ways."""
    e = expected.select("user_name", "product", F.lit(1).alias("e"), F.lit(0).alias("a"))
    a = actual.select("user_name", "product", F.lit(0).alias("e"), F.lit(1).alias("a"))
    return (e.unionByName(a).groupBy("user_name", "product")
            .agg(F.max("e").alias("expected"), F.max("a").alias("actual"))
            .filter("expected <> actual"))


def tenant_roles(members: DataFrame) -> DataFrame:
    """Enabled members per (tenant, role). A known role without a tenant is refused as an error."""
    known = members.filter(F.col("role").isin(*c.ROLES))
    problem = F.concat(F.lit("role without tenant: "), F.col("role"))
    checked = known.withColumn("tenant", F.when(
        F.col("tenant").isNull(), F.raise_error(problem)).otherwise(F.col("tenant")))
    return checked.filter("enabled").select("tenant", "role", "user_name").distinct()


# ---- classification and retention ---------------------------------------------------------------
def declaration(spark: SparkSession) -> DataFrame:
    return inline(spark, "scope, column_name, category, basis, personal", [
        (scope, name, *values) for scope, table in (
            ("fact", c.FACT_CLASSIFICATION), ("enrichment", c.ENRICHMENT_CLASSIFICATION))
        for name, values in table.items()])


def classification_drift(observed: DataFrame, declared: DataFrame) -> DataFrame:
    """Columns that reached the lake without a class."""
    return observed.join(
        F.broadcast(declared.select("scope", "column_name")), ["scope", "column_name"], "left_anti")


def observed_columns(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """The columns of live frames as rows, with the number of filled values of each."""
    parts = []
    for scope, df in frames.items():
        counts = df.agg(*[F.count(F.col(n)).alias(n) for n in df.columns])
        parts.append(counts.unpivot([], list(df.columns), "column_name", "filled")
                     .withColumn("scope", F.lit(scope)))
    return reduce(DataFrame.unionByName, parts)


def retention_plan(batches: DataFrame, as_of_day: str) -> DataFrame:
    """Which (layer, day) batches are past the retention of their layer; never under the floor."""
    days = F.when(F.lit(False), 0)
    for layer, limit in c.RETENTION_DAYS.items():
        days = days.when(F.col("layer") == layer, max(limit, c.RETENTION_FLOOR_DAYS))
    kept = days.otherwise(max(30, c.RETENTION_FLOOR_DAYS))
    age = F.datediff(F.to_date(F.lit(as_of_day)), F.to_date("ingest_day"))
    return batches.withColumn("age_days", age).withColumn("expired", F.col("age_days") > kept)


def sandbox_plan(items: DataFrame, as_of_ms: int, ttl_days: int, quota_mb: float) -> DataFrame:
    """Tables to drop per sandbox: the old ones, then the oldest others until the quota fits.

    The size of tables dropped for age is not taken off the total before the quota pass.
    """
    old = F.coalesce(F.col("last_changed") < as_of_ms - ttl_days * c.DAY_MS, F.lit(False))
    rows = items.filter(F.col("kind") == "TABLE").withColumn("old", old)
    totals = rows.groupBy("schema_name").agg(F.sum("megabytes").alias("total"))
    changed = F.coalesce("last_changed", F.lit(-c.DAY_MS))
    freed = prefix_sums(rows.withColumn("_at", changed), ["schema_name"], ["_at", "name"],
                        F.when(F.col("old"), 0.0).otherwise(F.col("megabytes")), "freed")
    over = (F.col("total") > quota_mb) & (F.col("total") - F.col("freed") > quota_mb)
    return (freed.join(totals, "schema_name").select(
        "schema_name", "name", "megabytes",
        F.when(F.col("old"), "untouched").when(over, "over quota").alias("reason"))
        .filter(F.col("reason").isNotNull()))


def sandbox_report(items: DataFrame) -> DataFrame:
    return items.groupBy("schema_name").agg(
        F.count_if(F.col("kind") == "VIEW").alias("views"),
        F.count_if(F.col("kind") == "TABLE").alias("tables"),
        F.sum("megabytes").alias("megabytes"))


def table_sizes(snapshots: DataFrame, files: DataFrame) -> DataFrame:
    """Size and last commit per table; both sides are aggregated before they meet."""
    last = snapshots.groupBy("table_name").agg(F.max("committed_at").alias("last_changed"),
                                               F.count(F.lit(1)).alias("snapshots"))
    size = files.groupBy("table_name").agg(F.sum("bytes").alias("bytes"))
    return last.join(size, "table_name", "left").withColumn(
        "megabytes", F.coalesce("bytes", F.lit(0)) / F.lit(1048576.0))


# ---- one subject --------------------------------------------------------------------------------
def subject_access(relations: dict[str, DataFrame], entity_id: str) -> DataFrame:
    """Rows held about one entity per table; tables without any are left out."""
    parts = [df.filter(F.col("entity_id") == entity_id).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows") for name, df in relations.items()]
    return reduce(DataFrame.unionByName, parts).filter("rows > 0")


def erase(relations: dict[str, DataFrame], entities: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every relation without the given entities, and what was removed from each.

    ``relations`` lists children before parents. The released application ids are reported under
    ``registry``.
    """
    subjects = entities.select("entity_id").distinct()
    kept = {name: df.join(subjects, "entity_id", "left_anti") for name, df in relations.items()}
    parts = [df.join(subjects, "entity_id", "left_semi").agg(F.count(F.lit(1)).alias("rows_removed"))
             .select(F.lit(name).alias("table_name"), "rows_removed")
             for name, df in relations.items()]
    if "applications" in relations:
        ids = (relations["applications"].join(subjects, "entity_id", "left_semi")
               .select("record_id").distinct())
        parts.append(ids.agg(F.count(F.lit(1)).alias("rows_removed"))
                     .select(F.lit("registry").alias("table_name"), "rows_removed"))
    return kept, reduce(DataFrame.unionByName, parts)
