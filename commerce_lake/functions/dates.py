"""Column helpers for dates, durations and calendar attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp").alias(name)


def tolerant_timestamp(col: Column | str) -> Column:
    """Timestamp, or null where the text is not one."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("timestamp")


def elapsed_days(start: str, end: str) -> Column:
    """Whole elapsed hours between two timestamps, expressed in days."""
    return F.timestamp_diff("HOUR", F.col(start), F.col(end)) / F.lit(24.0)


def elapsed_seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def day_gap(start: str, end: str) -> Column:
    """Calendar days from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start))


def is_after_deadline(event: str, deadline: str) -> Column:
    """True/false when both sides are known, null when either is missing."""
    return F.col(event) > F.col(deadline)


def month_after(day: date) -> Column:
    return F.add_months(F.lit(day), 1)


def calendar(day: str, last_complete_month: date) -> list[Column]:
    """Attributes of the date dimension, keyed on `day`."""
    d = F.col(day)
    return [
        d.alias("date_key"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.date_format(d, "yyyy-'Q'Q").alias("year_quarter"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("iso_week_number"),
        F.dayofweek(d).alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d < month_after(last_complete_month)).alias("is_complete_month"),
    ]
