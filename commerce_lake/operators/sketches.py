"""Quantile sketches that merge exactly: counts of values of equal leading digits.

A value is a whole number of units (cents, seconds). Values that agree in their
number of digits and in the leading ones share a bucket, so a bucket spans at
most one part in 10^(digits - 1) of its values, and a sketch has at most
9 * 10^(digits - 1) buckets for each number of digits and sign, whatever it
counts. Sketches of days merge by adding counts, in any order with the same
result, into the sketch of any range of days without reading facts again.

A quantile comes with bounds that hold exactly: the value lies between `low` and
`high`, and `rank_low` to `rank_high` are the ranks that this bucket's values have.

Defined results: null values count for nothing; null keys are a group; a group
without values has no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digit_counts(facts: DataFrame, keys: Sequence[str], units: Column, digits: int = 3) -> DataFrame:
    """(keys, low, high, n): how many values lie in each bucket, ends included.

    Equal buckets combine on the map side, so a hot group is one row per bucket
    and map task by the time it is shuffled.
    """
    value = units.cast("long")
    spelled = F.length(value.cast("string")) - F.when(value < 0, 1).otherwise(0)
    more = F.greatest(spelled - digits, F.lit(0))
    # Powers by lookup: floating powers of ten are not exact beyond 15 digits.
    step = F.element_at(F.array(*[F.lit(10**k).cast("long") for k in range(19)]), more + 1)
    valued = facts.select(*keys, value.alias("_value"), step.alias("_step")).where("_value IS NOT NULL")
    toward_zero = F.expr("_value - _value % _step")
    # The outermost buckets end where whole numbers of 64 bits do.
    wide = F.col("_step") - 1
    below = F.coalesce(F.try_subtract(toward_zero, wide), F.lit(-(2**63)))
    above = F.coalesce(F.try_add(toward_zero, wide), F.lit(2**63 - 1))
    negative = F.col("_value") < 0
    bounded = valued.select(
        *keys, F.when(negative, below).otherwise(toward_zero).alias("low"), F.when(negative, toward_zero).otherwise(above).alias("high")
    )
    return bounded.groupBy(*keys, "low", "high").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*keys, "low", "high").agg(F.sum("n").alias("n"))


def quantile_bounds(sketches: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(keys, p, low, high, rank_low, rank_high, total): one row per group and probability.

    The wanted rank is the smallest that covers the share `p`, from 1; a group's
    window holds its buckets, never its rows.
    """
    group = Window.partitionBy(*keys)
    ranked = sketches.withColumn("rank_high", F.sum("n").over(group.orderBy("low"))).withColumn("total", F.sum("n").over(group))
    points = F.explode(F.array(*[F.lit(Decimal(str(p))).cast("decimal(10,9)") for p in probabilities])).alias("p")
    each = ranked.withColumn("rank_low", F.col("rank_high") - F.col("n") + 1).select("*", points)
    rank = F.greatest(F.ceil(F.col("p") * F.col("total")).cast("long"), F.lit(1))
    found = each.where(rank.between(F.col("rank_low"), F.col("rank_high")))
    return found.select(*keys, F.col("p").cast("double").alias("p"), "low", "high", "rank_low", "rank_high", "total")
