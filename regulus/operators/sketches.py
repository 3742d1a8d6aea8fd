"""Medians that roll up: a mergeable sketch per cohort, merged at query time for any coarser group."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch. Its median's rank is within RANK_ERROR of one half; the published error of one sketch of this size is 0.14 per cent at
#: 99 per cent confidence, and the bound is five times that.
SIZE, RANK_ERROR = 2000, 0.007


def sketches(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """(keys, n, sketch) of the whole-number values of each group. Null values do not count; a group of them alone has no row."""
    rows = df.select(*keys, value.cast("bigint").alias("_v")).filter(F.col("_v").isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("_v", F.lit(SIZE)).alias("sketch"))


def merged(stored: DataFrame, keys: list[str], p: float = 0.5, out: str = "median") -> DataFrame:
    """(keys, n, quantile) of coarser groups, from the sketches alone: no value is read again."""
    rows = stored.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return rows.select(*keys, "n", F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(out))


def within_bound(found: DataFrame, df: DataFrame, keys: list[str], value: Column, p: float = 0.5, error: float = RANK_ERROR,
                 median: str = "median") -> DataFrame:
    """(keys, n, within_bound): whether the true ranks of the found quantile come within ``error`` of ``p``.

    A value that stands several times has several ranks; the nearest counts.
    """
    # a struct of keys is never null, so null keys meet
    group = F.struct(*keys).alias("_g")
    rows = df.select(group, value.cast("bigint").alias("_v")).filter(F.col("_v").isNotNull())
    both = rows.join(found.select(group, "n", F.col(median).alias("_q")), "_g")
    ranks = both.groupBy("_g", "n").agg(F.count_if(F.col("_v") < F.col("_q")).alias("below"), F.count_if(F.col("_v") <= F.col("_q")).alias("upto"))
    near = (F.col("below") <= (p + error) * F.col("n")) & (F.col("upto") >= (p - error) * F.col("n"))
    return ranks.select(*[F.col(f"_g.{k}").alias(k) for k in keys], "n", near.alias("within_bound"))
