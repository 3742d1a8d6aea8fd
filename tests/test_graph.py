"""Traversals and identity against brute force, with cycles, hubs and several paths."""
from __future__ import annotations

import random

from pyspark.sql import functions as F

from regulus.operators import graph, inventory

EDGES = "src string, dst string, type string, rule string, confidence double"
RESOURCES = ("urn string, provider string, kind string, name string, scope string, owner string, "
             "environment string, status string")


def edges(spark, pairs):
    return spark.createDataFrame([(a, b, "DEPENDS_ON", "declared", c) for a, b, c in pairs], EDGES)


def resources(spark, urns):
    return spark.createDataFrame(
        [(u, "p", "table", u, "default", None, None, "ok") for u in urns], RESOURCES)


def start(spark, urn):
    return spark.createDataFrame([(urn,)], "urn string")


def brute(pairs, begin, depth):
    """Least hops and least confidence per node over all walks up to the depth."""
    best, frontier = {}, {begin}
    for hop in range(1, depth + 1):
        following = set()
        for a, b, c in pairs:
            if a in frontier:
                h, low = best.get(b, (hop, c))
                best[b] = (h, min(low, c))
                following.add(b)
        frontier = following
    best.pop(begin, None)
    return best


def test_impact_with_cycles_and_many_paths(spark):
    rng = random.Random(2)
    nodes = [f"n{i}" for i in range(14)]
    pairs = list({(rng.choice(nodes), rng.choice(nodes)): None for _ in range(40)})
    pairs = [(a, b, rng.choice([0.6, 0.9, 1.0])) for a, b in pairs if a != b]
    frame, known = edges(spark, pairs), resources(spark, nodes[:10])
    for depth in (1, 3, 5):
        got = graph.impact(frame, known, start(spark, "n0"), "downstream", depth).collect()
        assert {r["urn"]: (r["hops"], r["confidence"]) for r in got} == brute(pairs, "n0", depth)
    back = [(b, a, c) for a, b, c in pairs]
    got = graph.impact(frame, known, start(spark, "n3"), "upstream").collect()
    assert {r["urn"]: (r["hops"], r["confidence"]) for r in got} == brute(back, "n3", 5)


def test_impact_of_a_leaf_is_empty(spark):
    frame = edges(spark, [("a", "b", 1.0)])
    reached = graph.impact(frame, resources(spark, ["a", "b"]), start(spark, "b"))
    assert reached.isEmpty()
    assert tuple(graph.impact_summary(reached).first()) == (0, 0)


def test_hub_with_most_edges(spark):
    pairs = [("hub", f"x{i}", 0.6) for i in range(300)] + [(f"x{i}", f"y{i % 5}", 1.0) for i in range(300)]
    reached = graph.impact(edges(spark, pairs), resources(spark, ["hub"]), start(spark, "hub"))
    assert tuple(graph.impact_summary(reached).first()) == (305, 300)
    assert graph.effective_access(reached).isEmpty()


def test_neighbourhood_and_trace(spark):
    pairs = [("a", "b", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("c", "d", 1.0), ("z", "b", 1.0)]
    nodes, found = graph.neighbourhood(edges(spark, pairs), start(spark, "a"), 1)
    assert {r["urn"] for r in nodes.collect()} == {"a", "b", "c"}
    assert {(r["src"], r["dst"]) for r in found.collect()} == {("a", "b"), ("c", "a")}
    nodes, found = graph.neighbourhood(edges(spark, pairs), start(spark, "a"), 9)
    assert nodes.count() == 5 and found.count() == 5
    flow = spark.createDataFrame([("j", a, b) for a, b, _ in pairs], "job string, source string, sink string")
    begin = spark.createDataFrame([("d",)], "dataset string")
    got = {r["dataset"]: r["level"] for r in graph.trace(flow, begin, "up").collect()}
    assert got == {"c": 1, "b": 2, "a": 3, "z": 3}


def test_failed_collection_keeps_and_marks_stale(spark):
    stored = resources(spark, ["a", "b"]).withColumn("owner", F.lit("team")).withColumn("stale", F.lit(False))
    nothing = stored.drop("stale").limit(0)
    merged = inventory.merge_sighting(stored, nothing, ["p"])
    assert merged.count() == 2 and merged.filter("stale AND changed").count() == 2
    again = inventory.merge_sighting(stored, resources(spark, ["a", "b"]), ["p"])
    assert again.filter("owner = 'team' AND NOT changed").count() == 2


def test_alias_priority_and_self_loops(spark):
    refs = spark.createDataFrame([
        ("s", "T", "ids", "1", "prov", "kind", None, "n", "native-id"),
        ("s", "T", None, None, "prov", "kind", None, "n", "declared"),
        ("s", "T", None, None, "prov", "kind", "sc", "m", "convention"),
        ("s", "T", None, None, "prov", None, None, "gone", "declared"),
        ("u2", "T", None, None, "prov", "kind", None, "n", "declared")],
        "src string, type string, source string, native_id string, provider string, kind string, "
        "scope string, name string, rule string")
    aliases = spark.createDataFrame([("ids::1", "u1"), ("prov::default/n", "u2")], "key string, urn string")
    known = spark.createDataFrame([("urn:infra:prov:kind:sc/m",)], "urn string")
    rows = inventory.resolve_references(refs, aliases, known)
    assert sorted((r["dst"], r["found_by"]) for r in rows.filter("src = 's' AND dst IS NOT NULL").collect()) == [
        ("u1", "native-id"), ("u2", "coordinates"), ("urn:infra:prov:kind:sc/m", "minted")]
    assert inventory.unresolved(rows).count() == 1
    kept = {(r["src"], r["dst"]): r["confidence"] for r in inventory.resolved_edges(rows).collect()}
    assert kept == {("s", "u1"): 1.0, ("s", "u2"): 0.9, ("s", "urn:infra:prov:kind:sc/m"): 0.6}


def test_stage_gates(spark):
    log = spark.createDataFrame([
        ("a", "ephemeral", "failed", 1), ("a", "ephemeral", "passed", 2), ("a", "staging", "failed", 3)],
        "item string, stage string, status string, at bigint")
    got = {r["stage"]: (r["state"], r["eligible"]) for r in inventory.stage_gates(log).collect()}
    assert got == {"ephemeral": ("passed", True), "staging": ("failed", True), "production": ("not run", False)}
