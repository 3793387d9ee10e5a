"""Exact distinct counts that merge: bitmaps of dense ids by day.

A day's ids are bitmaps of 32,768 ids each, so a day costs at most a bit per id
of the range it touches, and any set of days is an OR of their bitmaps. Facts
are read once, when a day is added. Ids should be dense integers: sparse ones
give many bitmaps with few bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_bitmaps(facts: DataFrame, day: Column, id: Column) -> DataFrame:
    """(day, bucket, ids): the ids of each day; null ids count for nothing.

    A hot day is one row per bucket and map task by the time it is shuffled.
    """
    named = facts.select(day.alias("day"), id.cast("long").alias("id")).where("id IS NOT NULL")
    buckets = named.groupBy("day", F.bitmap_bucket_number("id").alias("bucket"))
    return buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("ids"))


def distinct_ids(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids per group of days (or of anything else that rows of bitmaps carry)."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(name))
