"""Exact percentiles that never gather a whole group in one task.

Spark's `percentile` keeps a map of every distinct value of a group in memory.
Here values are counted first (equal values combine on the map side), a coarse
histogram finds the slice that holds each wanted rank, and only that slice is
ordered. With values in a range of size R at resolution r and slices of width w,
no task orders more than R / w slices or w / r values of one group.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranks(probability: float, total: Column, interpolate: bool) -> tuple[Column, Column, Column]:
    """Zero-based lower rank, upper rank and the weight of the upper one."""
    if interpolate:
        position = F.lit(float(probability)) * (total - 1).cast("double")
        low = F.floor(position)
        return low, F.ceil(position), position - low
    exact = F.ceil(F.lit(Decimal(str(probability))) * total)
    rank = F.greatest(exact.cast("bigint") - 1, F.lit(0).cast("bigint"))
    return rank, rank, F.lit(0.0)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    slice_width: Decimal | float,
    interpolate: bool = True,
) -> DataFrame:
    """One row per group with columns `p0, p1, ...`, one per probability.

    `interpolate=False` returns values that occur in the data.
    """
    keys = list(keys)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_slice", F.floor(F.col("_value") / F.lit(slice_width)))
    )
    ordered = Window.partitionBy(*keys).orderBy("_slice")
    slices = (
        counts.groupBy(*keys, "_slice")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_through", F.sum("_n").over(ordered))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    )

    total = F.col("_total")
    wanted = [_ranks(p, total, interpolate) for p in probabilities]
    before = F.col("_through") - F.col("_n")
    holds_rank = F.lit(False)
    for low, high, _ in wanted:
        for rank in (low, high):
            holds_rank = holds_rank | ((rank >= before) & (rank < F.col("_through")))
    hit_slices = slices.where(holds_rank).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_slice").alias("_hit"), before.alias("_before"), "_total"
    )
    # Null-safe, so that a null group stays, and so that no filter is derived
    # for one side only: both sides then share the shuffle of the counts.
    same = F.col("_slice").eqNullSafe(F.col("_hit"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))

    within = Window.partitionBy(*keys, "_slice").orderBy("_value")
    rows = counts.join(hit_slices, same).withColumn(
        "_end", F.col("_before") + F.sum("_n").over(within)
    )
    start, end = F.col("_end") - F.col("_n"), F.col("_end")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= start) & (rank < end), F.col("_value")))

    picks = []
    for i, (low, high, _) in enumerate(wanted):
        picks += [at(low).alias(f"_low{i}"), at(high).alias(f"_high{i}")]
    picked = rows.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)

    results = []
    for i, (_, _, weight) in enumerate(wanted):
        low, high = F.col(f"_low{i}").cast("double"), F.col(f"_high{i}").cast("double")
        results.append((low + (high - low) * weight).alias(f"p{i}"))
    return picked.select(*keys, *results)
