"""Marts: four facts that share four dimensions.

No join carries a broadcast hint. Dimensions are small in most data sets but
none has a proven size, so Spark decides from measured sizes, with a
skew-splitting sort-merge join as the other way.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.functions.dates import calendar, elapsed_days
from commerce_lake.functions.text import or_unknown
from commerce_lake.params import Params


def _coordinates(geo: DataFrame, zip_column: str, prefix: str) -> DataFrame:
    return geo.select(
        F.col("geolocation_zip_code_prefix").alias(zip_column),
        F.col("geolocation_lat").alias(f"{prefix}_latitude"),
        F.col("geolocation_lng").alias(f"{prefix}_longitude"),
    )


def dim_customer(history: DataFrame, geo: DataFrame) -> DataFrame:
    located = history.join(
        _coordinates(geo, "customer_zip_code_prefix", "customer"), "customer_zip_code_prefix", "left"
    )
    return located.select(
        F.col("customer_unique_id").alias("customer_key"),
        "customer_city", "customer_state", "customer_zip_code_prefix",
        "customer_latitude", "customer_longitude",
        "first_order_date", "last_order_date", "order_count", "delivered_order_count",
        "is_repeat_customer", "lifetime_revenue", "recency_days",
    )


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return bounds.select(F.explode(F.sequence("start", "end")).alias("day"))


def spine_covering(df: DataFrame, day: str) -> DataFrame:
    """Every day of the calendar years that the data touches."""
    bounds = df.agg(
        F.date_trunc("YEAR", F.min(day)).cast("date").alias("start"),
        F.date_sub(F.add_months(F.date_trunc("YEAR", F.max(day)), 12), 1).alias("end"),
    )
    return bounds.select(F.explode(F.sequence("start", "end")).alias("day"))


def dim_date(spine: DataFrame, params: Params) -> DataFrame:
    return spine.select(*calendar("day", params.last_complete_month))


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    named = products.join(translation, "product_category_name", "left")
    return named.select(
        F.col("product_id").alias("product_key"),
        or_unknown("product_category_name").alias("product_category_name"),
        or_unknown("product_category_name_english").alias("product_category_name_english"),
        *[c for c in products.columns if c not in ("product_id", "product_category_name")],
    )


def dim_seller(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    located = sellers.join(
        _coordinates(geo, "seller_zip_code_prefix", "seller"), "seller_zip_code_prefix", "left"
    )
    return located.select(
        F.col("seller_id").alias("seller_key"),
        "seller_city", "seller_state", "seller_zip_code_prefix",
        "seller_latitude", "seller_longitude",
    )


def fct_order_items(items: DataFrame, lifecycle: DataFrame) -> DataFrame:
    orders = lifecycle.select("order_id", "customer_key", "order_purchase_date", "order_status")
    return items.join(orders, "order_id").select(
        "order_id",
        "order_item_id",
        "customer_key",
        F.col("product_id").alias("product_key"),
        F.col("seller_id").alias("seller_key"),
        "order_purchase_date",
        "order_status",
        F.to_date("shipping_limit_date").alias("shipping_limit_date"),
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("line_gross_value"),
    )


def fct_orders(lifecycle_with_totals: DataFrame) -> DataFrame:
    """Accumulating snapshot per order."""
    return lifecycle_with_totals.select(
        "order_id", "customer_key", "order_purchase_date", "order_purchase_timestamp",
        "order_status", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        "approval_days", "handover_days", "delivery_days", "estimated_vs_actual_days",
        "is_late", "is_revenue_order", "item_count", "payment_count", "item_price_total",
        "freight_value_total", "item_gross_total", "payment_value_total",
        "payment_difference", "is_payment_reconciled",
    )


def fct_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )


def fct_reviews(reviews: DataFrame) -> DataFrame:
    title, message = F.col("review_comment_title"), F.col("review_comment_message")
    return reviews.select(
        "review_id",
        "order_id",
        "review_score",
        F.to_date("review_creation_date").alias("review_creation_date"),
        F.col("review_creation_date").alias("review_creation_timestamp"),
        "review_answer_timestamp",
        elapsed_days("review_creation_date", "review_answer_timestamp").alias("review_response_days"),
        title.alias("review_comment_title"),
        message.alias("review_comment_message"),
        (title.isNotNull() | message.isNotNull()).alias("has_comment"),
    )
