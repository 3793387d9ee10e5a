"""Intermediate models: lifecycles, reconciliation, histories, coordinates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.dates import elapsed_days, is_after_deadline
from commerce_lake.functions.numbers import zero_count, zero_money
from commerce_lake.operators.percentiles import exact_percentiles
from commerce_lake.params import Params

# Slice of a degree used to find a median: a country-sized range has about
# 41,000 slices, each with at most 1,000,000 values at nine decimals.
DEGREE_SLICE = Decimal("0.001")


def int_geolocation_deduped(geolocation: DataFrame, params: Params) -> DataFrame:
    """Median point of each zip prefix, from points inside the bounds.

    Both axes go through one percentile pass, told apart by a label.
    """
    inside = geolocation.where(
        F.col("geolocation_lat").between(*params.latitude_bounds)
        & F.col("geolocation_lng").between(*params.longitude_bounds)
    )
    pairs = [
        F.struct(F.lit(name).alias("axis"), F.col(name).alias("degrees"))
        for name in ("geolocation_lat", "geolocation_lng")
    ]
    axes = inside.select("geolocation_zip_code_prefix", F.inline(F.array(*pairs)))
    zip_axis = ["geolocation_zip_code_prefix", "axis"]
    medians = exact_percentiles(axes, zip_axis, "degrees", [0.5], DEGREE_SLICE)

    def of_axis(name: str):
        return F.max(F.when(F.col("axis") == name, F.round("p0", 9))).alias(name)

    return medians.groupBy("geolocation_zip_code_prefix").agg(
        of_axis("geolocation_lat"), of_axis("geolocation_lng")
    )


def int_order_lifecycle(orders: DataFrame, customers: DataFrame, params: Params) -> DataFrame:
    owners = customers.select("customer_id", F.col("customer_unique_id").alias("customer_key"))
    delivered, estimated = "order_delivered_customer_date", "order_estimated_delivery_date"
    return orders.join(owners, "customer_id").select(
        "order_id",
        "customer_key",
        "order_status",
        "order_purchase_timestamp",
        F.to_date("order_purchase_timestamp").alias("order_purchase_date"),
        "order_approved_at",
        "order_delivered_carrier_date",
        delivered,
        estimated,
        elapsed_days("order_purchase_timestamp", "order_approved_at").alias("approval_days"),
        elapsed_days("order_approved_at", "order_delivered_carrier_date").alias("handover_days"),
        elapsed_days("order_purchase_timestamp", delivered).alias("delivery_days"),
        elapsed_days(estimated, delivered).alias("estimated_vs_actual_days"),
        is_after_deadline(delivered, estimated).alias("is_late"),
        F.col("order_status").isin(*params.revenue_statuses).alias("is_revenue_order"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value_total"),
        F.count(F.lit(1)).alias("payment_count"),
    )


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum("price").alias("item_price_total"),
        F.sum("freight_value").alias("freight_value_total"),
        F.sum(F.col("price") + F.col("freight_value")).alias("item_gross_total"),
        F.count(F.lit(1)).alias("item_count"),
    )


def with_order_totals(
    orders: DataFrame, payments: DataFrame, items: DataFrame, params: Params
) -> DataFrame:
    """Add payment and item totals to any table with one row per order.

    Payments and lines are each summed per order before they meet; joining them
    row by row would multiply one by the number of the other.
    """
    joined = orders.join(payment_totals(payments), "order_id", "left").join(
        item_totals(items), "order_id", "left"
    )
    paid, gross = zero_money("payment_value_total"), zero_money("item_gross_total")
    return joined.select(
        *orders.columns,
        paid.alias("payment_value_total"),
        zero_count("payment_count").alias("payment_count"),
        zero_money("item_price_total").alias("item_price_total"),
        zero_money("freight_value_total").alias("freight_value_total"),
        gross.alias("item_gross_total"),
        zero_count("item_count").alias("item_count"),
        (paid - gross).alias("payment_difference"),
        (F.abs(paid - gross) <= F.lit(params.payment_tolerance)).alias("is_payment_reconciled"),
    )


def int_order_payment_totals(
    orders: DataFrame, payments: DataFrame, items: DataFrame, params: Params
) -> DataFrame:
    return with_order_totals(orders.select("order_id"), payments, items, params)


def int_customer_order_history(
    customers: DataFrame, orders: DataFrame, order_payments: DataFrame, params: Params
) -> DataFrame:
    """One row per stable customer; the address comes whole from the last order.

    `order_payments` holds `payment_value_total` with one row per order.
    """
    paid = order_payments.select("order_id", "payment_value_total")
    placed = customers.join(orders, "customer_id").join(paid, "order_id", "left")

    status = F.col("order_status")
    purchase = F.col("order_purchase_timestamp")
    address = F.struct("customer_city", "customer_state", "customer_zip_code_prefix")
    delivered = F.count_if(status == "delivered")
    earned = F.when(
        status.isin(*params.revenue_statuses), zero_money("payment_value_total")
    ).otherwise(zero_money(F.lit(None)))

    history = placed.groupBy("customer_unique_id").agg(
        F.max_by(address, F.struct(purchase, F.col("order_id"))).alias("address"),
        F.min(F.to_date(purchase)).alias("first_order_date"),
        F.max(F.to_date(purchase)).alias("last_order_date"),
        F.count(F.lit(1)).alias("order_count"),
        delivered.alias("delivered_order_count"),
        F.sum(earned).alias("lifetime_revenue"),
    )
    return history.select(
        "customer_unique_id",
        "address.*",
        "first_order_date",
        "last_order_date",
        "order_count",
        "delivered_order_count",
        (F.col("delivered_order_count") > 1).alias("is_repeat_customer"),
        "lifetime_revenue",
        F.datediff(F.lit(params.dataset_end), F.col("last_order_date")).alias("recency_days"),
    )
