"""Shares, running shares and one-row summaries over aggregated results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.functions.numbers import percent


def total_over_groups(name: str) -> Column:
    """Grand total beside each group.

    For results with a fixed, small number of groups (buckets, statuses,
    states). Where groups grow with the data use `grand_total`.
    """
    return F.sum(name).over(Window.partitionBy())


def share_of_groups(name: str, digits: int) -> Column:
    return percent(F.col(name), total_over_groups(name), digits)


def grand_total(df: DataFrame, name: str) -> Column:
    """Grand total as a scalar subquery: groups stay where they are.

    The other columns are folded as well: nothing is pruned below, so the
    subquery needs the same groups as its surroundings and Spark reuses them.
    """
    rest = [F.max(c) for c in df.columns if c != name]
    return df.agg(F.struct(F.sum(name).alias("total"), *rest).alias("folded")).scalar()["total"]


def running_share(name: str, order: Sequence[Column]) -> Column:
    """Running sum of two-digit shares, to one digit.

    For an already aggregated, bounded result. Shares are added as decimals, so
    a sum that ends in 5 rounds the same way every time.
    """
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.round(F.sum(F.col(name).cast("decimal(18,2)")).over(window), 1).cast("double")


def in_one_row(*summaries: DataFrame) -> DataFrame:
    """Put one-row summaries of different tables side by side.

    The rows are stacked and folded, so no join is needed and Spark runs the
    summaries as independent stages of one job.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), summaries)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
