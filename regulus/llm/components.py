"""Connected components of links, by rounds of joins over written tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulus.llm.store import written


def _linked_to_least(pairs: DataFrame) -> DataFrame:
    """(a, b) -> every b of an a linked to the least of a and its bs. The least is aggregated before the join, so a hot a is cheap."""
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return pairs.join(least, "a")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a and b): the root is the least node of its component.

    Alternates two steps until nothing changes: every node hands the least of its neighbourhood to its greater neighbours, then to the
    lesser ones. Each halves the distances, and the links become stars around the roots. Null ends and links to oneself are left out.
    """
    links = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(links.distinct(), "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _linked_to_least(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        links = written(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
