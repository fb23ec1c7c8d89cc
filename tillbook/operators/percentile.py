"""Exact ``percentile_cont`` per group, without gathering a group in one task.

Spark's built-in exact percentile keeps every distinct value of a group in
one aggregation buffer, and its final merge for a group runs in one task.
With a handful of groups over billions of rows (e.g. customer segments) that
is a single-task bottleneck.  This operator computes the same interpolated
value from sums:

1. histogram: ``(group, value) -> count`` (map-side combined, so repeated
   values such as zero revenue collapse before the shuffle);
2. counts per ``(group, range)``, where a range is a fixed slice of the number
   line about 1 % wide (``value_range``), so there are a few thousand per
   group at most and running sums over them are small;
3. the one or two ranges per group that hold the two target ranks; only their
   values are numbered and the two picked.

Everything is lazy: building the result starts no job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges per doubling of a value.
RANGES_PER_DOUBLING = 64


def null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def value_histogram(df: DataFrame, keys: list[str], value: str, *extra: Column) -> DataFrame:
    """``(keys, _v) -> _c``, NULL values among them, plus optional extra
    aggregates at the same grain (so a caller can derive other group
    statistics from the same, already combined, shuffle)."""
    return (
        df.withColumn("_v", F.col(value).cast("double")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"), *extra)
    )


def value_range(v: Column) -> Column:
    """Number of the slice that a double lies in; never falls as the value grows, the same in every run."""
    slice_ = F.floor(F.log2(F.abs(v)) * RANGES_PER_DOUBLING) + 100_000  # above 0 for every double but 0
    return F.when(v > 0, slice_).when(v < 0, -slice_).otherwise(F.lit(0).cast("bigint"))


def percentile_from_histogram(
    hist: DataFrame, keys: list[str], fraction: float = 0.5, alias: str = "percentile"
) -> DataFrame:
    """Interpolated percentile per group from a ``(keys, _v, _c)`` histogram (NULL values don't count)."""
    values = hist.where(F.col("_v").isNotNull()).select(*keys, "_v", "_c").withColumn("_range", value_range(F.col("_v")))

    in_group = Window.partitionBy(*keys)
    before = in_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        values.groupBy(*keys, "_range")
        .agg(F.sum("_c").alias("_size"))
        .select(
            *keys,
            "_range",
            "_size",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
            ((F.sum("_size").over(in_group) - 1).cast("double") * F.lit(float(fraction))).alias("_pos"),
        )
        .select("*", F.floor("_pos").alias("_lo"), F.ceil("_pos").alias("_hi"))
    )
    holds = lambda rank: (F.col("_offset") <= rank) & (rank < F.col("_offset") + F.col("_size"))
    own = [f"_key_{i}" for i in range(len(keys))]
    targets = ranges.where(holds(F.col("_lo")) | holds(F.col("_hi"))).select(
        *[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], F.col("_range").alias("_held"), "_offset", "_pos", "_lo", "_hi"
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own, strict=True)], F.col("_range") == F.col("_held"))
    near = values.join(targets, on).drop(*own, "_held")
    running = Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = near.withColumn("_end", F.col("_offset") + F.sum("_c").over(running))
    covers = lambda rank: (F.col("_end") - F.col("_c") <= rank) & (rank < F.col("_end"))
    picked = placed.groupBy(*keys).agg(
        F.max(F.when(covers(F.col("_lo")), F.col("_v"))).alias("_vlo"),
        F.max(F.when(covers(F.col("_hi")), F.col("_v"))).alias("_vhi"),
        F.max(F.col("_pos") - F.col("_lo")).alias("_frac"),
    )
    return picked.select(*keys, (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias(alias))


def percentile_cont(
    df: DataFrame, keys: list[str], value: str, fraction: float = 0.5, alias: str = "percentile"
) -> DataFrame:
    """One row per group in ``keys`` with the interpolated percentile (double).

    NULL values are ignored, as in SQL; a group with no non-NULL value has
    no row here (callers left-join the result to their group aggregate).
    """
    return percentile_from_histogram(value_histogram(df, keys, value), keys, fraction, alias)
