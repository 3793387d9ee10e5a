"""Labelled buckets and the state lookup used by the analyses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commerce_lake.params import Params

# Bucket limits and the labels that appear in results.
LATENESS_ON_TIME = "0  on time / early"
LATENESS_UPPER_DAYS = ((3, "1  1-3 days late"), (7, "2  4-7 days late"), (15, "3  8-15 days late"))
LATENESS_REST = "4  16+ days late"
ORDER_SEGMENTS = ((1, "1 order"), (2, "2 orders"), (3, "3 orders"))
ORDER_SEGMENT_REST = "4+ orders"
RECENCY_UPPER_DAYS = ((180, "0-180 days"), (365, "181-365 days"), (540, "366-540 days"))
RECENCY_REST = "540+ days"
FIRST_UNDELIVERED = "undelivered first order"
FIRST_LATE = "first order LATE"
FIRST_ON_TIME = "first order on time"

# Federal units of Brazil by official region.
REGION_STATES = {
    "North": ("AC", "AP", "AM", "PA", "RO", "RR", "TO"),
    "Northeast": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Central-West": ("DF", "GO", "MT", "MS"),
    "Southeast": ("ES", "MG", "RJ", "SP"),
    "South": ("PR", "RS", "SC"),
}


def upper_bound_label(value: Column, bounds, rest: str) -> Column:
    """Label of the first bound that is not below the value."""
    chain = F
    for limit, label in bounds:
        chain = chain.when(value <= limit, label)
    return chain.otherwise(rest)


def lateness(is_late: Column, days_late: Column) -> Column:
    late = upper_bound_label(days_late, LATENESS_UPPER_DAYS, LATENESS_REST)
    return F.when(~is_late, LATENESS_ON_TIME).otherwise(late)


def order_segment(order_count: Column) -> Column:
    chain = F
    for number, label in ORDER_SEGMENTS:
        chain = chain.when(order_count == number, label)
    return chain.otherwise(ORDER_SEGMENT_REST)


def recency(days: Column) -> Column:
    return upper_bound_label(days, RECENCY_UPPER_DAYS, RECENCY_REST)


def first_experience(is_late: Column) -> Column:
    return (
        F.when(is_late.isNull(), FIRST_UNDELIVERED)
        .when(is_late, FIRST_LATE)
        .otherwise(FIRST_ON_TIME)
    )


def tier_top(params: Params) -> str:
    return f"Top {params.pareto_cities} cities"


def tier_mid(params: Params) -> str:
    return f"Mid-tier cities (>{params.tail_orders} orders)"


def tier_tail(params: Params) -> str:
    return f"Long tail (≤{params.tail_orders} orders)"


def state_regions(spark):
    """(state, region): 27 rows, so a join against it is always broadcast."""
    rows = [(state, region) for region, states in REGION_STATES.items() for state in states]
    return spark.createDataFrame(rows, "state string, region string")
