"""Exact top-k by inner product, by aggregation of sorted lists without random access.

In a block of candidates every dimension is a list sorted by value. A query reads the lists in step: from the top where its component is
positive, from the bottom where it is negative, so that contributions only fall. After each stretch every candidate has a lower bound
(unread components at their worst) and an upper bound (unread components at the lists' present values). Reading stops when only
a few candidates can still be among the k best; their scores are then resolved in full.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regulus.llm.store import written

#: Candidates of a block, queries of a block, queries read side by side, candidates that are resolved.
BLOCK, QUERIES, SIDE_BY_SIDE, RESOLVED = 8192, 4096, 256, 512
#: Shares of the lists after which the bounds are compared.
STRETCHES = (0.125, 0.25, 0.375, 0.5, 0.55, 0.6, 0.7, 0.8, 1.0)
FOUND = "query_id long, vec_id long, score long"


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; components that a vector does not have are 0."""
    column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


class Lists:
    """The sorted lists of a block of candidates."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by_id], x[by_id]
        order = np.argsort(self.x, axis=0, kind="stable")
        self.values = np.take_along_axis(self.x, order, axis=0)
        # the place of every candidate in every list
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(ids))[:, None], axis=0)

    def search(self, own: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (with id ``own``) the places of its k best candidates and their scores."""
        n = len(self.ids)
        out: list = [None] * len(own)
        open_ = np.arange(len(own))
        # whole numbers: sums that stay below 2^24 are exact in single precision, at half the memory
        small = np.abs(self.x).max(axis=0) @ np.abs(q).max(axis=0) < 1 << 24
        kind = np.float32 if small else np.float64
        x, values, known = self.x.astype(kind), self.values.astype(kind), np.zeros((n, len(own)), dtype=kind)
        up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
        read = 0
        for share in STRETCHES:
            upto = n if share == 1.0 else int(n * share)
            if upto == read:
                continue
            # the entries of this stretch, from the top and from the bottom of every list
            known += np.where((self.rank >= n - upto) & (self.rank < n - read), x, 0) @ up[open_].T
            known += np.where((self.rank >= read) & (self.rank < upto), x, 0) @ down[open_].T
            read = upto
            upper = known
            if read < n:
                high, low = (self.rank < n - read).astype(kind), (self.rank >= read).astype(kind)
                upper = known + high @ (up[open_] * values[n - read - 1]).T + low @ (down[open_] * values[read]).T
            first, last = np.searchsorted(self.ids, own[open_], "left"), np.searchsorted(self.ids, own[open_], "right")
            going = []
            for j, i in enumerate(open_):
                ceiling = upper[:, j].copy()
                ceiling[first[j]:last[j]] = -np.inf
                several = min(n, 4 * k)
                best = np.argpartition(-ceiling, several - 1)[:several]
                best = best[np.isfinite(ceiling[best])]
                if len(best) == 0:
                    out[i] = np.zeros(0, dtype=np.int64), np.zeros(0)
                    continue
                floor = known[best, j]
                if read < n:
                    floor = floor + (self.rank[best] < n - read) @ (up[i] * values[0]) + (self.rank[best] >= read) @ (down[i] * values[-1])
                # k candidates are at least this good; equals stay, as the smaller id decides
                least = np.partition(floor, len(floor) - k)[len(floor) - k] if len(floor) > k else -np.inf
                rest = np.flatnonzero(ceiling >= least)
                if read < n and len(rest) > RESOLVED:
                    going.append(j)
                    continue
                rest = rest[np.isfinite(ceiling[rest])]
                scores = known[rest, j] if read == n else self.x[rest] @ q[i]
                top = np.lexsort((self.ids[rest], -scores))[:k]
                out[i] = rest[top], scores[top]
            if not going:
                break
            open_, known = open_[going], known[:, going]
        return out


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """The k best candidates of each query: query_id, rank from 1, vec_id, score; ties to the smaller vec_id.

    Both tables have ``vec_id`` and ``vector``, an array of whole numbers as doubles. A query is no candidate of its own: rows with its id are left
    out. Candidates repeated under one id are rows each, equal queries one; different vectors under one query id share its rows. Vectors of unequal length are compared over the components both have. Fewer
    candidates than k give fewer rows, an empty table none. Blocks of queries meet blocks of candidates, both of bounded size.
    """
    n, n_queries = candidates.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // query_block))
    # the block is settled before the row is repeated, as the place of a repeated row is another one
    place = F.monotonically_increasing_id()
    left = (candidates.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", place), F.lit(blocks)).alias("block"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block")))
    right = (queries.dropDuplicates(["vec_id", "vector"])
             .select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(query_blocks)).cast("int").alias("query_block"))
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")))

    def run(some: pa.Table, asked: pa.Table) -> pa.Table:
        found = [(np.zeros(0, dtype=np.int64),) * 3]
        if some.num_rows and asked.num_rows:
            width = max(int(np.max(t["vector"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False))) for t in (some, asked))
            lists = Lists(some["vec_id"].to_numpy(), _matrix(some["vector"], width))
            ids, q = asked["vec_id"].to_numpy(), _matrix(asked["vector"], width)
            for i in range(0, len(ids), SIDE_BY_SIDE):
                own = ids[i:i + SIDE_BY_SIDE]
                for query, (rows, scores) in zip(own, lists.search(own, q[i:i + SIDE_BY_SIDE], k)):
                    found.append((np.full(len(rows), query), lists.ids[rows], scores.astype(np.int64)))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], names=["query_id", "vec_id", "score"])

    found = left.groupBy("block", "query_block").cogroup(right.groupBy("block", "query_block")).applyInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def whole_vectors(df: DataFrame, column: str = "embedding", times: int = 256) -> DataFrame:
    """(vec_id, vector): every component x becomes floor(times * x), x as double; unusable vectors and rows without an id are left out."""
    doubles = df.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    fit = doubles.where(usable("vector"))
    return written(fit.select("vec_id", F.transform("vector", lambda x: F.floor(x * times).cast("double")).alias("vector")), "vectors")
