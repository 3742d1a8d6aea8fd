"""Hard negatives by inner product, found in cover trees.

Candidates are dealt to blocks, and a cover tree over the norm-augmented vectors of a block answers the anchors. The first descent finds
each anchor's best rows of its own label. Their scores make windows, and a second descent finds for each window the best rows of other
labels inside it.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regulus.llm.cover_tree import Asked, CoverTree
from regulus.llm.store import written
from regulus.llm.topk_search import _matrix, usable

#: Candidates of a block, anchors of a block, units that descend side by side.
BLOCK, ANCHORS, SIDE_BY_SIDE = 8192, 4096, 128


def _descents(candidates: DataFrame, asked: DataFrame, same: bool, k: int, block: int, anchors: int) -> DataFrame:
    """(unit, vec_id, score): the ``k`` best candidates of each unit in each block.

    ``asked`` has unit, anchor_id, label, vector, low and high. Every block of candidates meets every block of units, both of bounded size.
    """
    blocks, unit_blocks = max(1, -(-candidates.count() // block)), max(1, -(-asked.count() // anchors))
    place = F.monotonically_increasing_id()
    left = (candidates.select("vec_id", "label", "vector", F.pmod(F.xxhash64("vec_id", place), F.lit(blocks)).alias("block"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(unit_blocks - 1))).alias("unit_block")))
    # the units of an anchor stay together, so that its vector is read once
    right = (asked.select("*", F.pmod(F.xxhash64("anchor_id", "vector"), F.lit(unit_blocks)).cast("int").alias("unit_block"))
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")))

    def run(some: pa.Table, units: pa.Table) -> pa.Table:
        out = [(np.zeros(0, dtype=np.int64),) * 3]
        if some.num_rows and units.num_rows:
            width = max(int(np.max(t["vector"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False))) for t in (some, units))
            tree = CoverTree(some["vec_id"].to_numpy(), some["label"].to_numpy(), _matrix(some["vector"], width))
            units = units.sort_by([("anchor_id", "ascending"), ("unit", "ascending")])
            q, own = _matrix(units["vector"], width), units["anchor_id"].to_numpy()
            number, low, high, label = (units[c].to_numpy() for c in ("unit", "low", "high", "label"))
            for i in range(0, len(own), SIDE_BY_SIDE):
                s = slice(i, i + SIDE_BY_SIDE)
                vectors, query = np.unique(q[s], axis=0, return_inverse=True)
                asked_ = Asked(query.reshape(-1), low[s], high[s], label[s], own[s], same, k)
                for unit, (rows, scores) in zip(number[s], tree.search(vectors, asked_)):
                    out.append((np.full(len(rows), unit), tree.ids[rows], scores.astype(np.int64)))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["unit", "vec_id", "score"])

    found = left.groupBy("block", "unit_block").cogroup(right.groupBy("block", "unit_block")).applyInArrow(run, "unit long, vec_id long, score long")
    order = Window.partitionBy("unit").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(anchors: DataFrame, candidates: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Both tables have vec_id, label and vector, an array of whole numbers as doubles, none of them null. An anchor's positives are its best
    ``positives`` rows of its label; rows under its own id are not among them. For each positive the best ``negatives`` rows of another
    label are taken whose score is ``low`` to ``high`` per cent of the positive's. Higher scores come first, ties by the smaller vec_id.
    Fewer rows give fewer results, empty tables none. Candidates repeated under one id are rows each; equal anchors are one. Vectors of
    unequal length are compared over the components both have. Other columns are not read, so none can clash.
    """
    own = anchors.dropDuplicates(["vec_id", "label", "vector"]).select(
        F.col("vec_id").alias("anchor_id"), F.col("label").cast("long").alias("label"), "vector")
    own = written(own.withColumn("unit", F.monotonically_increasing_id()), "anchors")
    candidates = candidates.select("vec_id", F.col("label").cast("long").alias("label"), "vector")
    everything = own.select("*", F.lit(-float("inf")).alias("low"), F.lit(float("inf")).alias("high"))
    best = written(_descents(candidates, everything, True, positives, block, anchor_block).select(
        "unit", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place")), "positives")
    # whole scores: low * positive <= 100 * negative <= high * positive. Without a score of 0 or more there is no such window.
    windows = own.join(best.where("positive_score >= 0"), "unit").select(
        (F.col("unit") * positives + F.col("place") - 1).alias("unit"), "anchor_id", "label", "vector", "positive_id", "positive_score",
        F.expr(f"(positive_score * {low} + 99) div 100").cast("double").alias("low"), F.expr(f"(positive_score * {high}) div 100").cast("double").alias("high"))
    windows = written(windows, "windows")
    found = _descents(candidates, windows.drop("positive_id", "positive_score"), False, negatives, block, anchor_block)
    found = found.select("unit", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return windows.select("unit", "anchor_id", "positive_id", "positive_score").join(found, "unit").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def labelled_vectors(df: DataFrame, column: str = "embedding", times: int = 256) -> DataFrame:
    """(vec_id, label, vector): every component x becomes floor(times * x), x as double. Rows with a null id or label, with a null
    vector or with a null or non-finite component are left out."""
    doubles = df.where("vec_id is not null and label is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(column).cast("array<double>").alias("vector"))
    fit = doubles.where(usable("vector"))
    return written(fit.select("vec_id", "label", F.transform("vector", lambda x: F.floor(x * times).cast("double")).alias("vector")), "labelled-vectors")
