"""Sources mixed to target weights by balanced sampling with the cube method.

A source whose target is t and whose size is s takes each document t / s times on average: the whole part for certain, the rest as an
inclusion probability. The cube method moves the probabilities of a block of documents through the null space of the balancing
constraints (tokens and documents) until all but a few are 0 or 1, so both totals stay what they were. The few of all blocks, and some of every
size that no flight moved, form the next round's blocks, until one small landing problem per source remains: of the roundings of its
units one that comes near to the totals. Sources of any size are split into blocks of bounded size; rows that are equal in everything
are numbered and dealt to blocks by their number, so that many of them make many blocks.
"""
from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regulus.llm.store import row_key, written
from regulus.llm.words import SPACES

#: Weights of the sources in their order, repeated.
WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST_TIMES = 3
#: Documents of a block, those of a block that no flight moves but that are kept for the landing, and those whose roundings are all tried.
BLOCK, KEPT, TRIED = 2_000, 64, 12
#: Orders in which a landing is tried.
ORDERS = 64
_EDGE = 1e-9


def flight(p: np.ndarray, sizes: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Move probabilities within the constraints until at most two are fractional.

    Three fractional units always have a direction that keeps the sum of p and the sum of p * size; a step along it, as far as the cube
    allows, to either side with the chance that keeps every expectation, settles at least one of them.
    """
    p = p.copy()
    order = random.permutation(np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))).tolist()
    scale = float(sizes.max()) or 1.0
    x = (sizes / scale).tolist()
    value = p.tolist()
    held: list[int] = []
    draws = iter(random.random(2 * len(order) + 8).tolist())
    while order or len(held) > 2:
        while len(held) < 3 and order:
            held.append(order.pop())
        if len(held) < 3:
            break
        a, b, c = held
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(held, u):
            if d > 0:
                up, down = min(up, (1 - value[i]) / d), min(down, value[i] / d)
            elif d < 0:
                up, down = min(up, value[i] / -d), min(down, (1 - value[i]) / -d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(held, u):
            value[i] += step * d
        settled = [i for i in held if value[i] < _EDGE or value[i] > 1 - _EDGE]
        for i in settled:
            value[i] = 0.0 if value[i] < 0.5 else 1.0
        held = [i for i in held if i not in settled]
    return np.clip(np.array(value), 0.0, 1.0)


def kept_back(p: np.ndarray, sizes: np.ndarray, most: int = KEPT) -> np.ndarray:
    """The fractional units that wait for the landing: some of every size, so that their roundings make up for almost any number of tokens."""
    open_ = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
    if len(open_) <= most:
        return open_
    by_size = open_[np.argsort(sizes[open_], kind="stable")]
    return by_size[np.unique(np.linspace(0, len(by_size) - 1, most).round().astype(int))]


def settled(p: np.ndarray, sizes: np.ndarray, last: bool, random: np.random.Generator) -> np.ndarray:
    """One flight over all units but those kept back, and in the last round the landing of what is left."""
    moved = np.ones(len(p), dtype=bool)
    moved[kept_back(p, sizes)] = False
    p = p.copy()
    if moved.any():
        p[moved] = flight(p[moved], sizes[moved], random)
    return landing(p, sizes, random) if last else p


def landing(p: np.ndarray, sizes: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Settle the last units. In many orders, the larger ones are rounded one by one, each to where the tokens then come nearest to what was
    expected, and all roundings of the smallest ones are tried; the outcome whose tokens, then documents, come nearest is taken."""
    open_ = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
    if len(open_) == 0:
        return np.round(p)
    open_ = open_[np.lexsort((random.random(len(open_)), -sizes[open_]))]
    large, small = open_[:max(0, len(open_) - TRIED)], open_[max(0, len(open_) - TRIED):]
    choices = (np.arange(1 << len(small))[:, None] >> np.arange(len(small))) & 1
    tokens, number = choices @ sizes[small] - p[small] @ sizes[small], choices.sum(axis=1) - p[small].sum()
    best = None
    for turn in range(ORDERS if len(large) else 1):
        out, off, more = p.copy(), 0.0, 0.0
        for i in large if turn == 0 else random.permutation(large):
            up, down = off + (1 - p[i]) * sizes[i], off - p[i] * sizes[i]
            out[i] = float(abs(up) < abs(down))
            off, more = (up, more + 1 - p[i]) if out[i] else (down, more - p[i])
        k = np.lexsort((random.random(len(choices)), np.abs(more + number), np.abs(off + tokens)))[0]
        out[small] = choices[k]
        missed = abs(off + tokens[k]), abs(more + number[k])
        if best is None or missed < best[0]:
            best = missed, out
    return np.round(best[1])


def _seed(*parts: object) -> np.random.Generator:
    return np.random.default_rng(zlib.crc32("\x1f".join(map(str, parts)).encode()))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``.

    Weights repeat over the sources in code-point order, null last. A target stops at ``most_times`` the size of its source and the excess
    is shared anew by weight, until none is above: below their limits all targets are one common multiple of the weights. That
    multiple is found by rounds of one small aggregate each; only sums reach the driver.
    """
    # the place of a source: rows of its range before it, and those of the ranges before; one row per range and not per source
    ranged = written(sources.repartitionByRange(F.col("source").isNull(), F.col("source"))
                     .sortWithinPartitions(F.col("source").isNull(), F.col("source"))
                     .withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "sources")
    counts = {r["__part"]: r["n"] for r in ranged.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for part in sorted(counts):
        before.append(F.struct(F.lit(part).alias("__part"), F.lit(total).cast("long").alias("__before")))
        total += counts[part]
    if not before:
        return sources.select("*", F.lit(0).alias("weight"), F.lit(0.0).alias("target"))
    places = sources.sparkSession.range(1).select(F.inline(F.array(*before)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("__before") + F.col("__row")) % len(weights) + 1).cast("int"))
    placed = written(ranged.join(F.broadcast(places), "__part").select("source", "source_size", weight.alias("weight")), "weights")
    limit = most_times * F.col("source_size")
    size = placed.agg(F.sum("source_size")).first()[0] or 0
    multiple, at_limit = 0.0, -1
    while True:
        over = limit < multiple * F.col("weight") if at_limit >= 0 else F.lit(False)
        row = placed.agg(F.sum(F.when(over, limit)).alias("limits"), F.sum(F.when(~over, F.col("weight"))).alias("weights"),
                         F.count(F.when(over, 1)).alias("n")).first()
        if row["n"] == at_limit or not row["weights"]:
            break
        at_limit, multiple = row["n"], (size - (row["limits"] or 0)) / row["weights"]
    return placed.withColumn("target", F.least(limit.cast("double"), F.lit(float(multiple)) * F.col("weight")))


def _settle(units: DataFrame, block, last: bool, seed: str) -> DataFrame:
    """One round over blocks of (source, block)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "equal"], kind="stable").reset_index(drop=True)
        random = _seed(seed, pdf["source_key"].iloc[0], pdf["block"].iloc[0], len(pdf))
        sizes = pdf["size"].to_numpy(dtype=float)
        pdf["p"] = settled(pdf["p"].to_numpy(dtype=float), sizes, last, random)
        return pdf

    return units.withColumn("block", block).groupBy("source_key", "block").applyInPandas(run, units.withColumn("block", block).schema)


def mix(df: DataFrame, text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES,
        block: int = BLOCK, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``df``: its columns named in ``carry``, size, source, source_size, target and ``times`` it is taken.

    Sizes are words; a null text has none, and a document or source without words is never taken. Repeated rows are units of their own,
    told apart by a number among equals. Results depend only on the rows and the seed, not on their order. An empty table gives an empty one.
    """
    words = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(f"[^{SPACES}]+")).cast("long")
    rows = df.select(*carry, F.col(source).cast("string").alias("source"), words.alias("size"), row_key(*df.columns).alias("key"))
    rows = written(rows.withColumn("copy", F.monotonically_increasing_id()), "sizes")
    # equal rows are interchangeable, so any numbering of them gives the same result
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = written(source_targets(sources.select("source", "source_size"), weights, most_times)
                      .join(sources.select(F.col("source").alias("__s"), "n"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rate = F.least(rate, F.lit(float(most_times)))
    source_key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    # a source with a third of all rows stays where its rows are: the small side is sent to them
    whole = F.floor(rate + F.lit(_EDGE))
    rated = (_with_targets(rows, targets)
             .withColumn("whole", whole).withColumn("p", F.greatest(F.lit(0.0), rate - F.col("whole"))))
    open_ = F.when(F.col("size") > 0, F.col("p")).otherwise(F.lit(0.0)) > _EDGE
    units = _numbered(rated.where(open_).select(source_key.alias("source_key"), "key", "copy", "size", "p", "n"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block))
    round_, seeds = 0, f"{seed}-0"
    current = written(_settle(units, F.pmod(F.xxhash64("key", "equal", F.lit(seeds)), blocks).cast("long"), False, seeds), "flight")
    done = [current.where((F.col("p") < _EDGE) | (F.col("p") > 1 - _EDGE))]
    rest = current.where((F.col("p") >= _EDGE) & (F.col("p") <= 1 - _EDGE))
    while True:
        round_ += 1
        seeds = f"{seed}-{round_}"
        left = rest.groupBy("source_key").agg(F.count("*").alias("n"))
        most = left.agg(F.max("n")).first()[0] or 0
        last = most <= block
        units = rest.drop("n", "block").join(left, "source_key")
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block))
        current = written(_settle(units.select("source_key", "key", "copy", "size", "p", "n", "equal"),
                                  F.pmod(F.xxhash64("key", "equal", F.lit(seeds)), blocks).cast("long"), last, seeds), "flight")
        if last:
            done.append(current)
            break
        done.append(current.where((F.col("p") < _EDGE) | (F.col("p") > 1 - _EDGE)))
        rest = current.where((F.col("p") >= _EDGE) & (F.col("p") <= 1 - _EDGE))
    settled = done[0].select("copy", "p")
    for frame in done[1:]:
        settled = settled.unionByName(frame.select("copy", "p"))
    taken = settled.where("p > 0.5").select("copy", F.lit(1).alias("extra"))
    # the same join at every size: the units taken grow with the input, so they are never sent whole to all executors
    return (rated.join(taken.hint("merge"), "copy", "left")
            .select(*carry, "source", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.col("whole") + F.coalesce(F.col("extra"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("times")))


def _numbered(units: DataFrame) -> DataFrame:
    """``units`` with ``equal``, their number among equal rows. Rows of a task are numbered first, and then the tasks of each key, so
    no task sees all of many equal rows."""
    part = F.shiftrightunsigned("copy", 33)
    rows = units.withColumn("part", part)
    counts = rows.groupBy("key", "part").agg(F.count("*").alias("m"))
    many = counts.groupBy("key").agg(F.sum("m").alias("all")).where(F.col("all") > 1).select("key")
    # most rows have no equal
    before = F.sum("m").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.join(many, "key", "left_semi").select("key", "part", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("key", "part").orderBy("copy")) - 1
    again = rows.join(starts, ["key", "part"]).select(*units.columns, (own + F.col("before")).cast("long").alias("equal"))
    alone = rows.join(many, "key", "left_anti").select(*units.columns, F.lit(0).cast("long").alias("equal"))
    return written(alone.unionByName(again), "units")


def _with_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    own = targets.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("__key"), "source_size", "target", "n")
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    return rows.withColumn("__key", key).join(own, "__key").drop("__key")
