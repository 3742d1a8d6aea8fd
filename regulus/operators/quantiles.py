"""Exact quantiles and running totals that never bring one group together in one task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regulus.session import Cuts

#: Bins of a level, and levels. Every level cuts the spread of the values that are left.
BINS, LEVELS = 4096, 2


def exact_quantiles(df: DataFrame, keys: list[str], value: str, p: float = 0.5,
                    weight: str | None = None, out: str = "median") -> DataFrame:
    """The interpolated quantile of ``value`` per group, exact.

    Equal values are counted before the shuffle. A group's own spread is cut into bins, their counts show which bins hold the
    wanted ranks, and the spread of those is cut again; only the distinct values of the last bins are ranked. So whatever the unit and
    wherever the values lie, a task sees the bins of a group or about a 16-millionth of its spread. A null key is a group like any
    other; null values do not count, and a group of them alone has no row.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    # The keys travel as one struct: it is never null, and equal where its nulls are, so null groups
    # join like the others and both uses of the counts share one shuffle.
    counts = (df.groupBy(F.struct(*keys).alias("_g"), F.col(value).alias("_v")).agg(n.alias("_n"))
              .filter(F.col("_g").isNotNull() & F.col("_v").isNotNull()))
    position = (F.sum("_n") - 1) * F.lit(float(p))
    groups = counts.groupBy("_g").agg(F.min("_v").alias("_least"), F.max("_v").alias("_most"), position.alias("_pos"))

    def holds(rank: str, start: str, size: str):
        return (F.col(start) <= F.col(rank)) & (F.col(rank) < F.col(start) + F.col(size))

    scope = F.struct(F.lit(0).cast("bigint").alias("id"), "_least", "_most", F.lit(0).cast("bigint").alias("start"), "_pos",
                     F.floor("_pos").alias("_lo"), F.ceil("_pos").alias("_hi"))
    rows = counts.join(groups.select("_g", scope.alias("s")), "_g").select("_g", "_v", "_n", "s.*")
    for _ in range(LEVELS):
        width = F.col("_most") - F.col("_least")
        bin_ = F.when(width > 0, F.least((F.col("_v") - F.col("_least")) / width * BINS, F.lit(BINS - 1.0))).otherwise(0.0)
        rows = rows.withColumn("_bin", F.floor(bin_))
        bins = rows.groupBy("_g", "id", "_bin").agg(
            F.sum("_n").alias("_bn"), F.min("_v").alias("_l"), F.max("_v").alias("_m"), F.max("start").alias("_s"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        earlier = F.sum("_bn").over(Window.partitionBy("_g", "id").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
        bins = bins.withColumn("_s", F.col("_s") + F.coalesce(earlier, F.lit(0)))
        wanted = bins.filter(holds("_lo", "_s", "_bn") | holds("_hi", "_s", "_bn")).select("_g", "id", "_bin", "_s", "_l", "_m")
        rows = rows.drop("start", "_least", "_most").join(wanted, ["_g", "id", "_bin"]).select(
            "_g", "_v", "_n", (F.col("id") * BINS + F.col("_bin")).alias("id"), F.col("_l").alias("_least"), F.col("_m").alias("_most"),
            F.col("_s").alias("start"), "_pos", "_lo", "_hi")
    inside = Window.partitionBy("_g", "id").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_start", F.col("start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    low = F.max(F.when(holds("_lo", "_start", "_n"), F.col("_v")))
    high = F.max(F.when(holds("_hi", "_start", "_n"), F.col("_v")))
    share = F.max(F.col("_pos") - F.col("_lo"))
    found = ranked.groupBy("_g").agg((low + (high - low) * share).alias(out))
    return found.select(*[F.col(f"_g.{k}").alias(k) for k in keys], out)


def with_quantiles(groups: DataFrame, quantiles: DataFrame, keys: list[str]) -> DataFrame:
    """Groups with their quantiles; a group without any stays, and null keys meet."""
    rest = [c for c in quantiles.columns if c not in keys]
    return groups.withColumn("_g", F.struct(*keys)).join(
        quantiles.select(F.struct(*keys).alias("_g"), *rest), "_g", "left").drop("_g")


def running_total_before(df: DataFrame, keys: list[str], bucket: Column, order: list[str],
                         value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of each group, ordered by bucket and then ``order``.

    The order must agree with the bucket. Totals per bucket are summed first, and rows are only
    ordered within their bucket, so a group with most of the rows is spread over its buckets.
    """
    rows = df.withColumn("_b", bucket).withColumn("_v", value)
    earlier = Window.unboundedPreceding, -1
    over_buckets = Window.partitionBy(*keys).orderBy("_b").rowsBetween(*earlier)
    starts = (rows.groupBy(*keys, "_b").agg(F.sum("_v").alias("_bv"))
              .withColumn("_start", F.coalesce(F.sum("_bv").over(over_buckets), F.lit(0)))
              .drop("_bv"))
    inside = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(*earlier)
    return (rows.join(starts, [*keys, "_b"])
            .withColumn(out, F.col("_start") + F.coalesce(F.sum("_v").over(inside), F.lit(0)))
            .drop("_b", "_v", "_start"))


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, parts: int | None = None) -> DataFrame:
    """Sum of ``value`` over the earlier rows of each group, whatever part of the rows a group or a stretch of the order holds.

    Rows are dealt by ranges of keys, order and content, with bounds from a sample, and written so that the ranges stay. A group's
    totals by range are summed first; then rows are ordered within their range only. ``parts`` is the number of ranges. Rows of equal order are
    taken in the order of their content.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_v", value).withColumn("_g", F.struct(*keys)).withColumn("_tie", F.xxhash64(*df.columns))
    ranged = rows.repartitionByRange(parts, "_g", *order, "_tie").withColumn("_part", F.spark_partition_id())
    ranged = Cuts(spark).cut(ranged)
    before = (Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_g", "_part").agg(F.sum("_v").alias("_pv"))
    starts = starts.select("_g", "_part", F.coalesce(F.sum("_pv").over(Window.partitionBy("_g").orderBy("_part").rowsBetween(*before)), F.lit(0)).alias("_start"))
    inside = F.sum("_v").over(Window.partitionBy("_g", "_part").orderBy(*order, "_tie").rowsBetween(*before))
    return (ranged.join(starts, ["_g", "_part"]).withColumn(out, F.col("_start") + F.coalesce(inside, F.lit(0)))
            .select(*df.columns, out))
