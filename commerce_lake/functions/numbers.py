"""Column helpers for money, counts, rates and shares.

Money is DECIMAL(18,2): sums widen to (28,2) without losing a cent, and the
result of a sum does not depend on how rows were spread over tasks.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
COORDINATE = DecimalType(18, 9)
_CENTS = DecimalType(15, 0)


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def whole(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def to_money(col: Column | str) -> Column:
    """The value as money, as a cast gives it.

    A cast writes a double out as text and reads it again. Nearly every amount is
    the double next to a whole number of cents, which one division tells; up to 15
    digits no two amounts share a double, so those cents are its value.
    """
    value = _col(col)
    amount = value.try_cast("double")
    cents = F.rint(amount * 100)
    exact = (cents / 100.0 == amount) & (F.abs(cents) < 1e15)
    return F.when(exact, cents.cast("bigint").cast(_CENTS) * F.lit(Decimal("0.01"))).otherwise(value.cast(MONEY))


def money(name: str) -> Column:
    return to_money(name).alias(name)


def coordinate(name: str) -> Column:
    return F.col(name).cast(COORDINATE).alias(name)


def double(col: Column | str) -> Column:
    return _col(col).cast("double")


def zero_money(col: Column | str) -> Column:
    return F.coalesce(_col(col), F.lit(0).cast(MONEY))


def zero_count(col: Column | str) -> Column:
    return F.coalesce(_col(col), F.lit(0).cast("bigint"))


def rounded(col: Column | str, digits: int = 0) -> Column:
    return F.round(double(col), digits)


def mean(col: Column | str) -> Column:
    """Average as an exact decimal or integer sum over a count.

    Unlike a running average of doubles, the result is the same whatever the
    order in which partial results are merged.
    """
    col = _col(col)
    return double(F.sum(col)) / F.count(col)


def ratio(numerator: Column, denominator: Column) -> Column:
    return double(numerator) / F.nullif(double(denominator), F.lit(0.0))


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    return F.round(F.lit(100.0) * ratio(numerator, denominator), digits)


def percent_where(condition: Column, digits: int) -> Column:
    """Share of rows for which the condition holds; null counts as a miss."""
    return percent(F.count_if(condition), F.count(F.lit(1)), digits)
