"""Staging models: one cleaned projection per raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.dates import timestamp
from commerce_lake.functions.numbers import coordinate, money, whole
from commerce_lake.functions.text import blank_to_null, lower_text, trimmed, upper_code
from commerce_lake.operators.ranking import first_per_group


def stg_customers(raw: DataFrame) -> DataFrame:
    ids = [trimmed(c) for c in ("customer_id", "customer_unique_id", "customer_zip_code_prefix")]
    return raw.select(*ids, lower_text("customer_city"), upper_code("customer_state"))


def stg_orders(raw: DataFrame) -> DataFrame:
    moments = (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    )
    return raw.select(
        trimmed("order_id"), trimmed("customer_id"), lower_text("order_status"),
        *[timestamp(c) for c in moments],
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        trimmed("order_id"), whole("order_item_id"), trimmed("product_id"), trimmed("seller_id"),
        timestamp("shipping_limit_date"), money("price"), money("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        trimmed("order_id"), whole("payment_sequential"), lower_text("payment_type"),
        whole("payment_installments"), money("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    cleaned = raw.select(
        trimmed("review_id"), trimmed("order_id"), whole("review_score"),
        *[blank_to_null(c).alias(c) for c in ("review_comment_title", "review_comment_message")],
        timestamp("review_creation_date"), timestamp("review_answer_timestamp"),
    )
    latest = [F.col("review_answer_timestamp").desc_nulls_last(), F.col("order_id")]
    return first_per_group(cleaned, ["review_id"], latest)


def stg_products(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )
    measures = (
        "product_name_length", "product_description_length", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )
    category = blank_to_null(F.lower("product_category_name"))
    return renamed.select(
        trimmed("product_id"), category.alias("product_category_name"), *[whole(c) for c in measures]
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        trimmed("seller_id"), trimmed("seller_zip_code_prefix"),
        lower_text("seller_city"), upper_code("seller_state"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return raw.select(
        trimmed("geolocation_zip_code_prefix"),
        coordinate("geolocation_lat"), coordinate("geolocation_lng"),
        lower_text("geolocation_city"), upper_code("geolocation_state"),
    )


def stg_product_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        lower_text("product_category_name"), lower_text("product_category_name_english")
    )
