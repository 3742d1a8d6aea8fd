"""Inventory of resources: collection, identity resolution, change marking, search and gates."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regulus.contract import CONFIDENCE, MANAGED, STAGE_LADDER
from regulus.functions.columns import urn

FACETS = ("provider", "kind", "scope", "environment", "owner", "status")
STATE_SCHEMA = (
    "workspace string, serial bigint, resources array<struct<type: string, name: string,"
    " mode: string, provider: string, instances: array<struct<index_key: string,"
    " dependencies: array<string>, attributes: map<string, string>>>>>")


# ---- collection ---------------------------------------------------------------------------------
def state_resources(states: DataFrame) -> DataFrame:
    """One row per declared instance of state documents, with its address and dependencies.

    A resource without instances yields no row; without an index the address is the plain one.
    """
    rows = (states.select("workspace", F.explode("resources").alias("r"))
            .select("workspace", "r.type", "r.name", F.coalesce("r.mode", F.lit("managed")).alias("mode"),
                    F.explode("r.instances").alias("i")))
    plain = F.concat("type", F.lit("."), "name")
    address = F.when(F.col("i.index_key").isNull(), plain).otherwise(
        F.concat(plain, F.lit("["), F.col("i.index_key"), F.lit("]")))
    provider, kind = F.lit("terraform"), F.lit("state_resource")
    return rows.select(
        urn(provider, kind, F.col("workspace"), address).alias("urn"), "workspace", "type",
        address.alias("address"), "mode", F.col("i.attributes").alias("attributes"),
        F.coalesce("i.dependencies", F.array().cast("array<string>")).alias("dependencies"))


def state_workspaces(states: DataFrame) -> DataFrame:
    """The workspace of every state document, which its instances are contained in."""
    return states.select(
        urn(F.lit("terraform"), F.lit("workspace"), F.lit("iac"), F.col("workspace")).alias("urn"),
        "workspace", "serial", F.size("resources").alias("resource_count")).distinct()


def managed_edges(instances: DataFrame) -> DataFrame:
    """The runtime objects that instances declare to manage, by the attribute that names them."""
    attributes, kind = F.col("attributes"), F.col("type")
    parts = []
    for rule in MANAGED:
        name = attributes[rule.attribute]
        scope = F.lit(rule.scope)
        if rule.nested:
            name = F.get_json_object(attributes[rule.attribute], "$[0].name")
            scope = F.coalesce(F.get_json_object(attributes[rule.attribute], "$[0].namespace"), scope)
        if rule.rule == "declared-filename":
            name = F.element_at(F.split(name, "/"), -1)
        fits = kind.rlike(rule.type_pattern) & name.isNotNull() & (name != "")
        what = F.lit(rule.kind) if rule.kind else F.regexp_replace(F.regexp_replace(kind, "^kubernetes_", ""), "_v1", "")
        parts.append(F.when(fits, F.struct(
            urn(F.lit(rule.provider), what, scope, name).alias("target"), F.lit(rule.rule).alias("rule"))))
    # the first attribute that names the object counts
    return (instances.select(F.col("urn").alias("src"), F.lit("MANAGES").alias("type"), F.coalesce(*parts).alias("m"))
            .filter("m is not null").select("src", "type", "m.target", "m.rule"))


def inventory_stats(resources: DataFrame, edges: DataFrame) -> DataFrame:
    """Totals of resources, stale ones and edges, and resources by provider and by kind."""
    cells = resources.groupBy("provider", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("stale").alias("stale"))
    row = lambda measure, value, n: F.struct(F.lit(measure).alias("measure"), value.alias("value"), n.alias("n"))
    every = F.lit("all")
    counted = cells.select(F.explode(F.array(
        row("resources", every, F.col("n")), row("stale", every, F.col("stale")),
        row("provider", F.col("provider"), F.col("n")), row("kind", F.col("kind"), F.col("n")))).alias("r"))
    total = edges.agg(F.lit("edges").alias("measure"), every.alias("value"), F.count(F.lit(1)).alias("n"))
    return (counted.select("r.*").groupBy("measure", "value").agg(F.sum("n").alias("n"))
            .unionByName(total))


def candidate_edges(instances: DataFrame) -> DataFrame:
    """Containment in the workspace and declared dependencies of collected instances."""
    contains = instances.select(
        F.col("urn").alias("src"), F.lit("CONTAINS").alias("type"),
        F.concat(F.lit("workspace::"), "workspace").alias("target"), F.lit("state-file").alias("rule"))
    depends = instances.select(
        F.col("urn").alias("src"), F.lit("DEPENDS_ON").alias("type"),
        F.explode("dependencies").alias("d"), F.lit("tfstate-dependencies").alias("rule")).select(
        "src", "type", F.concat(F.lit("address::"), "d").alias("target"), "rule")
    return contains.unionByName(depends)


# ---- identity -----------------------------------------------------------------------------------
def resolve_references(references: DataFrame, aliases: DataFrame, resources: DataFrame) -> DataFrame:
    """The target of each reference: native id first, then coordinates, then a minted name.

    ``aliases`` and ``resources`` are unique per key, so each left join keeps the row count.
    """
    scope = F.coalesce("scope", F.lit("default"))

    def key(value: Column) -> Column:
        # A reference without this kind of key gets one of its own that matches nothing, so the
        # rows without a key spread over the tasks instead of meeting in the one of null.
        return F.coalesce(value, F.concat(F.lit("none::"), "src", F.lit("|"), "type"))

    keyed = references.withColumns({
        "native_key": key(F.concat("source", F.lit("::"), "native_id")),
        "coordinate_key": key(F.concat("provider", F.lit("::"), scope, F.lit("/"), "name")),
        "minted": key(F.when(F.col("provider").isNotNull() & F.col("kind").isNotNull()
                             & F.col("name").isNotNull(),
                             urn(F.col("provider"), F.col("kind"), F.col("scope"), F.col("name"))))})
    by_native = aliases.select(F.col("key").alias("native_key"), F.col("urn").alias("u1"))
    by_place = aliases.select(F.col("key").alias("coordinate_key"), F.col("urn").alias("u2"))
    existing = resources.select(F.col("urn").alias("minted"), F.col("urn").alias("u3"))
    joined = (keyed.join(by_native, "native_key", "left").join(by_place, "coordinate_key", "left")
              .join(existing, "minted", "left"))
    found = (F.when(F.col("u1").isNotNull(), "native-id").when(F.col("u2").isNotNull(), "coordinates")
             .when(F.col("u3").isNotNull(), "minted"))
    return joined.withColumn("dst", F.coalesce("u1", "u2", "u3")).withColumn("found_by", found).drop(
        "native_key", "coordinate_key", "minted", "u1", "u2", "u3")


def resolved_edges(resolved: DataFrame) -> DataFrame:
    """Edges between different resources, one per (src, dst, type), the most trusted rule first."""
    confidence = F.lit(None).cast("double")
    for rule, value in CONFIDENCE.items():
        confidence = F.when(F.col("rule") == rule, value).otherwise(confidence)
    usable = resolved.filter(F.col("dst").isNotNull() & (F.col("dst") != F.col("src")))
    return (usable.withColumn("confidence", confidence).groupBy("src", "dst", "type")
            .agg(F.max(F.struct("confidence", "rule")).alias("best"))
            .select("src", "dst", "type", F.col("best.rule").alias("rule"),
                    F.col("best.confidence").alias("confidence")))


def unresolved(resolved: DataFrame) -> DataFrame:
    """References without a target are kept and listed, never dropped."""
    return resolved.filter(F.col("dst").isNull())


# ---- change marking -----------------------------------------------------------------------------
def merge_sighting(stored: DataFrame, sighting: DataFrame, providers: list[str]) -> DataFrame:
    """Stored resources after one collection.

    A resource seen again takes the new values, but keeps its owner and environment where the new
    sighting does not know them. A resource of a collected provider that was not seen is marked
    stale and stays. ``changed`` says whether the write altered a row.
    """
    names = [n for n in stored.columns if n not in ("urn", "stale")]
    old = stored.select("urn", F.struct(*names, "stale").alias("o"))
    new = sighting.select("urn", F.struct(*names).alias("n"))
    both = old.join(new, "urn", "full_outer")
    seen, known = F.col("n").isNotNull(), F.col("o").isNotNull()

    def value(name: str) -> Column:
        fresh = F.coalesce(f"n.{name}", f"o.{name}") if name in ("owner", "environment") else F.col(f"n.{name}")
        return F.when(seen, fresh).otherwise(F.col(f"o.{name}"))

    stale = F.when(seen, F.lit(False)).when(F.col("o.provider").isin(*providers), True).otherwise(
        F.col("o.stale"))
    merged = both.select("urn", "o", known.alias("_known"), *[value(n).alias(n) for n in names],
                         stale.alias("stale"))
    same = reduce(lambda a, b: a & b, [F.col(f"o.{n}").eqNullSafe(F.col(n)) for n in (*names, "stale")])
    return merged.withColumn("changed", ~(F.col("_known") & same)).drop("o", "_known")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of every plugin."""
    rest = [n for n in runs.columns if n != "plugin"]
    return runs.groupBy("plugin").agg(F.max_by(F.struct(*rest), "id").alias("r")).select("plugin", "r.*")


# ---- search -------------------------------------------------------------------------------------
def matching(resources: DataFrame, text: str | None = None, **facets: str) -> DataFrame:
    """Resources whose name, urn or scope contains the text, under equality facets."""
    rows = resources
    if text:
        # Matching ignores the case of letters, as the inventory search does.
        needle = F.lit(text.lower())
        rows = rows.filter(F.lower("name").contains(needle) | F.lower("urn").contains(needle)
                           | F.lower("scope").contains(needle))
    for name, value in facets.items():
        rows = rows.filter(F.col(name) == value)
    return rows


def page(rows: DataFrame, limit: int, offset: int) -> DataFrame:
    """One page in a total order, with the size of the whole result.

    The total is joined as a one-row aggregate; the page itself is a top-k, not a full sort.
    """
    total = rows.agg(F.count(F.lit(1)).alias("total")).withColumn("_k", F.lit(1))
    part = rows.orderBy("provider", "kind", "name", "urn").offset(offset).limit(limit)
    return part.withColumn("_k", F.lit(1)).join(total, "_k").drop("_k")


def facet_counts(rows: DataFrame, names: tuple[str, ...] = FACETS) -> DataFrame:
    """Counts per facet value under the same filter; empty values are left out.

    Rows are first counted per combination of facet values, and only the combinations are unpivoted.
    """
    cells = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return (cells.unpivot("n", list(names), "facet", "value").filter(
        F.col("value").isNotNull() & (F.col("value") != ""))
        .groupBy("facet", "value").agg(F.sum("n").alias("count")))


def with_ends(edges: DataFrame, resources: DataFrame) -> DataFrame:
    """Relations with kind and name of both ends; unknown ends stay."""
    def end(name: str) -> DataFrame:
        return resources.select(F.col("urn").alias(name), F.col("kind").alias(f"{name}_kind"),
                                F.col("name").alias(f"{name}_name"))
    return edges.join(end("src"), "src", "left").join(end("dst"), "dst", "left")


def keyword_search(texts: DataFrame, terms: list[str], key: str, text: str,
                   tier: str | None = None) -> DataFrame:
    """Rows that contain every query term as a word, with the tier and the number of occurrences.

    A plain substring test drops most rows before any word is looked at, and no text is split: words
    are counted where they stand. A term that is not one word occurs nowhere.
    """
    wanted = sorted({t.lower() for t in terms})
    edge = r"(?<![\p{L}\p{N}])(?:%s)(?![\p{L}\p{N}])"
    rows = texts.select(key, *([tier] if tier else []), F.lower(F.col(text)).alias("_t"))
    for term in wanted:
        rows = rows.filter(F.col("_t").contains(term) & F.lit(term.isalnum()))
    for term in wanted:
        rows = rows.filter(F.col("_t").rlike(edge % term))
    return rows.select(key, *([tier] if tier else []),
                       F.regexp_count("_t", F.lit(edge % "|".join(wanted))).alias("score"))


# ---- stage gates --------------------------------------------------------------------------------
def stage_gates(verifications: DataFrame, ladder: tuple[str, ...] = STAGE_LADDER) -> DataFrame:
    """State and eligibility of every item on every stage; a stage is open once the one below passed.

    The latest verification per (item, stage) is pivoted into one row per item, so a stage looks at
    its neighbour within the row.
    """
    wide = verifications.groupBy("item").agg(*[
        F.max_by(F.when(F.col("stage") == s, F.col("status")),
                 F.when(F.col("stage") == s, F.col("at"))).alias(s) for s in ladder])
    entries = []
    for rank, stage in enumerate(ladder):
        open_ = F.lit(True) if rank == 0 else F.coalesce(F.col(ladder[rank - 1]) == "passed", F.lit(False))
        entries.append(F.struct(F.lit(stage).alias("stage"), F.lit(rank).alias("rank"),
                                F.coalesce(stage, F.lit("not run")).alias("state"),
                                open_.alias("eligible")))
    return wide.select("item", F.explode(F.array(*entries)).alias("g")).select("item", "g.*")


def previous_stage_status(gates: DataFrame) -> DataFrame:
    """The state of the stage below; an item has as many rows as the ladder has stages."""
    return gates.withColumn("previous_state", F.lag("state").over(
        Window.partitionBy("item").orderBy("rank")))
