"""Keep the leading rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first `n` rows of each group with their 1-based position.

    The position filter directly above the window lets Spark keep only `n` rows
    per group in each map task before the shuffle, so one very large group
    never reaches a single task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return ranked(df, keys, order, 1, "_position").drop("_position")
