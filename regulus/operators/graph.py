"""Traversals of a relation graph by joins, one round per hop.

Every round joins the distinct frontier to the edges, and its result is written to the shared
folder, so the plan stays one join deep however many rounds run and a lost executor costs one
round. The rounds' folders are dropped once the result is written. Frontiers are distinct nodes, so paths that meet are followed once.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulus.contract import GRANT_KINDS, LOW_CONFIDENCE
from regulus.functions.columns import confidence_label
from regulus.session import Cuts


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def directed(edges: DataFrame, direction: str) -> DataFrame:
    """Edges as (node, next): along the arrows downstream, against them upstream."""
    a, b = ("src", "dst") if direction == "downstream" else ("dst", "src")
    return edges.select(F.col(a).alias("node"), F.col(b).alias("next"), "type", "rule", "confidence")


def impact(edges: DataFrame, resources: DataFrame, starts: DataFrame, direction: str = "downstream",
           max_depth: int = 5) -> DataFrame:
    """Everything reachable from ``starts`` (a ``urn`` column): least hops, least confidence over
    all arriving relations, and the relation of the shortest arrival.

    A node may be reached again on a longer way, which can lower its confidence; cycles end at the
    depth limit.
    """
    cuts = Cuts(edges.sparkSession)
    steps = directed(edges, direction)
    start = starts.select(F.col("urn").alias("node")).distinct()
    frontier, levels = start, []
    for hops in range(1, max_depth + 1):
        arrived = (steps.join(frontier, "node").groupBy(F.col("next").alias("urn"))
                   .agg(F.min("confidence").alias("confidence"),
                        F.min(F.struct("type", "rule")).alias("via"))
                   .withColumn("hops", F.lit(hops)))
        arrived = cuts.cut(arrived)
        if arrived.isEmpty():
            break
        levels.append(arrived)
        frontier = arrived.select(F.col("urn").alias("node"))
    if not levels:
        levels = [steps.limit(0).select(
            F.col("next").alias("urn"), "confidence", F.struct("type", "rule").alias("via"),
            F.lit(0).alias("hops"))]
    reached = _union(levels).groupBy("urn").agg(
        F.min("hops").alias("hops"), F.min("confidence").alias("confidence"),
        F.min(F.struct("hops", "via")).alias("first"))
    reached, = cuts.result(reached)
    reached = reached.join(start.select(F.col("node").alias("urn")), "urn", "left_anti")
    return (reached.join(resources.select("urn", "kind", "name", "provider", "scope", "status"),
                         "urn", "left")
            .select("urn", "hops", F.col("first.via.type").alias("type"),
                    F.col("first.via.rule").alias("rule"), "confidence", "kind", "name",
                    "provider", "scope", "status",
                    confidence_label("confidence").alias("confidence_label")))


def impact_summary(reached: DataFrame) -> DataFrame:
    """How much is affected and how much of it rests on a weak relation."""
    return reached.agg(F.count(F.lit(1)).alias("count"),
                       F.count_if(F.coalesce("confidence", F.lit(1.0)) < LOW_CONFIDENCE)
                       .alias("low_confidence"))


def effective_access(reached: DataFrame) -> DataFrame:
    """The part of a principal's reach that grants something."""
    return reached.filter(F.col("kind").isin(*GRANT_KINDS))


RELATION = ["src", "dst", "type", "rule", "confidence"]


def neighbourhood(edges: DataFrame, starts: DataFrame, depth: int = 1, types: list[str] | None = None,
                  resources: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges around ``starts``, relations followed both ways, depth 1 to 5.

    Edges keep their rule and confidence; nodes have the columns of ``resources``, unknown ones null.
    """
    cuts = Cuts(edges.sparkSession)
    if types:
        edges = edges.filter(F.col("type").isin(*types))
    both = edges.select(F.col("src").alias("node"), F.col("dst").alias("next"), *RELATION
                        ).unionByName(edges.select(F.col("dst").alias("node"),
                                                   F.col("src").alias("next"), *RELATION))
    seen = starts.select(F.col("urn").alias("node")).distinct()
    frontier, found = seen, []
    for _ in range(max(1, min(depth, 5))):
        touched = cuts.cut(both.join(frontier, "node").select(*RELATION, "next"))
        found.append(touched.select(*RELATION))
        frontier = cuts.cut(touched.select(F.col("next").alias("node")).distinct()
                               .join(seen, "node", "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    nodes, relations = cuts.result(seen.select(F.col("node").alias("urn")), _union(found).distinct())
    return (nodes if resources is None else nodes.join(resources, "urn", "left")), relations


def trace(edges: DataFrame, starts: DataFrame, direction: str = "up", max_level: int = 8) -> DataFrame:
    """Datasets upstream or downstream with the level at which they are first met.

    ``edges`` has source, job and sink. A node is expanded once, so cycles end by themselves.
    """
    cuts = Cuts(edges.sparkSession)
    a, b = ("sink", "source") if direction == "up" else ("source", "sink")
    steps = cuts.cut(edges.select(F.col(a).alias("node"), F.col(b).alias("next")).distinct())
    seen = starts.select(F.col("dataset").alias("node")).distinct().withColumn("level", F.lit(0))
    frontier, levels = seen.select("node"), [seen]
    for level in range(1, max_level + 1):
        reached = (steps.join(frontier, "node").select(F.col("next").alias("node")).distinct()
                   .join(_union(levels).select("node"), "node", "left_anti"))
        fresh = cuts.cut(reached.withColumn("level", F.lit(level)))
        if fresh.isEmpty():
            break
        levels.append(fresh)
        frontier = fresh.select("node")
    return cuts.result(_union(levels).filter("level > 0").select(F.col("node").alias("dataset"), "level"))[0]


def trace_edges(edges: DataFrame, starts: DataFrame, direction: str = "up",
                max_level: int = 8) -> DataFrame:
    """The relations walked by a trace: level of the expanded dataset, job, dataset and next one."""
    a, b = ("sink", "source") if direction == "up" else ("source", "sink")
    begin = starts.select("dataset").distinct()
    levels = trace(edges, begin, direction, max_level).unionByName(
        begin.withColumn("level", F.lit(0)))
    # a start that a cycle leads back to is expanded at level 0 only
    nodes = levels.groupBy(F.col("dataset").alias("node")).agg(F.min("level").alias("level"))
    steps = edges.select("job", F.col(a).alias("node"), F.col(b).alias("next")).distinct()
    return steps.join(nodes, "node").select("level", "job", "node", "next")
