"""Customer histories folded forward from the months that changed.

A customer's history is made of parts that merge: counts and sums add up, the
first and last day are the least and greatest, the address is that of the
greatest (purchase, order). A state is kept per customer and purchase month, in a
table of months. When orders of some months change, the states of these months
alone are made anew from their orders (other orders are cut at the scan) and the
payments of these orders, and the history is the states summed per customer: a
month has a row per customer who bought in it.

Defined results: a month without orders any more has no state; customers without
any state are gone; orders of a null purchase moment form a month of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.numbers import zero_money
from commerce_lake.params import Params
from commerce_lake.plans import intermediate
from commerce_lake.plans.models import Models
from commerce_lake.sources import versions
from commerce_lake.sources.storage import Lake, replace_days, write_partitioned

MONTH = "purchase_month"
TABLE = "customer_months"
CLUSTER = ("customer_unique_id",)


def month_of(moment: Column) -> Column:
    return F.trunc(moment, "MM")


def customer_months(customers: DataFrame, orders: DataFrame, order_payments: DataFrame, params: Params) -> DataFrame:
    """One mergeable state per customer and purchase month."""
    paid = order_payments.select("order_id", "payment_value_total")
    placed = customers.join(orders, "customer_id").join(paid, "order_id", "left")
    purchase, status = F.col("order_purchase_timestamp"), F.col("order_status")
    address = F.struct("customer_city", "customer_state", "customer_zip_code_prefix")
    earned = F.when(status.isin(*params.revenue_statuses), zero_money("payment_value_total")).otherwise(zero_money(F.lit(None)))
    moment = F.struct(purchase.alias("purchase"), F.col("order_id").alias("order_id"))
    return placed.groupBy("customer_unique_id", month_of(purchase).alias(MONTH)).agg(
        F.max(F.struct(moment.alias("at"), address.alias("address"))).alias("latest"),
        F.min(F.to_date(purchase)).alias("first_order_date"), F.max(F.to_date(purchase)).alias("last_order_date"),
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(status == "delivered").alias("delivered_order_count"),
        F.sum(earned).alias("lifetime_revenue"),
    )


def folded(months: DataFrame, params: Params) -> DataFrame:
    """The history of every customer from the states of their months."""
    merged = months.groupBy("customer_unique_id").agg(
        F.max("latest").alias("latest"),
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
        *[F.sum(c).alias(c) for c in ("order_count", "delivered_order_count", "lifetime_revenue")],
    )
    return merged.select(
        "customer_unique_id", "latest.address.*", "first_order_date", "last_order_date",
        "order_count", "delivered_order_count",
        (F.col("delivered_order_count") > 1).alias("is_repeat_customer"),
        F.col("lifetime_revenue").cast("decimal(28,2)").alias("lifetime_revenue"),
        F.datediff(F.lit(params.dataset_end), F.col("last_order_date")).alias("recency_days"),
    )


def _of(m: Models, orders: DataFrame) -> DataFrame:
    """States of some orders. Payments and customers are cut to these orders before they are summed."""
    some = orders.select("order_id", "customer_id")
    payments = m.stg_order_payments.join(some.select("order_id"), "order_id", "left_semi")
    customers = m.stg_customers.join(some.select("customer_id").distinct(), "customer_id", "left_semi")
    return customer_months(customers, orders, intermediate.payment_totals(payments), m.params)


def _path(lake: Lake) -> str:
    return lake.path("intermediate", TABLE)


def store(m: Models, lake: Lake) -> DataFrame:
    """States of all months; the history of every customer."""
    months = customer_months(m.stg_customers, m.stg_orders, intermediate.payment_totals(m.stg_order_payments), m.params)
    return folded(write_partitioned(months, _path(lake), MONTH, CLUSTER), m.params)


def fold_in(m: Models, lake: Lake, months: Sequence[str | None]) -> DataFrame:
    """The history after orders, payments or customers of these purchase months (their first days) have changed."""
    month = month_of(F.col("order_purchase_timestamp"))
    changed = _of(m, m.stg_orders.where(versions.is_one_of(month, set(months))))
    return folded(replace_days(changed, _path(lake), MONTH, CLUSTER, months), m.params)
