"""Location models: map-ready revenue by buyer and by seller place.

These read raw tables, not staging ones. Payments and lines are summed before
they are joined, so a very large order is already one row when it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.dates import tolerant_timestamp
from commerce_lake.functions.numbers import COORDINATE, mean, to_money
from commerce_lake.functions.text import or_unknown


def geo_dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """Mean point per zip prefix; the smallest place name stands for any."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        mean(F.col("geolocation_lat").cast(COORDINATE)).alias("latitude"),
        mean(F.col("geolocation_lng").cast(COORDINATE)).alias("longitude"),
        F.min("geolocation_city").alias("city"),
        F.min("geolocation_state").alias("state"),
    )


def geo_dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(translation, "product_category_name", "left").select(
        "product_id",
        or_unknown("product_category_name_english").alias("product_category_name_english"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def _points(geo: DataFrame, zip_column: str) -> DataFrame:
    return geo.select(F.col("zip_code_prefix").alias(zip_column), "latitude", "longitude")


def fact_sale_order_location(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, geo: DataFrame
) -> DataFrame:
    paid = payments.groupBy("order_id").agg(
        F.sum(to_money("payment_value")).alias("total_order_revenue")
    )
    delivered = orders.where(F.col("order_status") == "delivered").select(
        "order_id", "customer_id", "order_purchase_timestamp"
    )
    located = (
        delivered.join(customers, "customer_id")
        .join(paid, "order_id")
        .join(_points(geo, "customer_zip_code_prefix"), "customer_zip_code_prefix", "left")
    )
    return located.select(
        "order_id", "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", F.upper("customer_state").alias("customer_state"),
        "latitude", "longitude", "total_order_revenue",
        tolerant_timestamp("order_purchase_timestamp").alias("order_purchase_timestamp"),
    )


def fact_revenue_by_product_seller_location(
    items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame, geo: DataFrame
) -> DataFrame:
    sold = items.groupBy("order_id", "product_id", "seller_id").agg(
        F.sum(to_money("price") + to_money("freight_value")).alias("revenue")
    )
    delivered = orders.where(F.col("order_status") == "delivered").select("order_id")
    named = products.select("product_id", "product_category_name_english")
    by_seller = (
        sold.join(delivered, "order_id")
        .join(named, "product_id")
        .groupBy("product_category_name_english", "seller_id", "order_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    located = sellers.join(_points(geo, "seller_zip_code_prefix"), "seller_zip_code_prefix", "left")
    return by_seller.join(located, "seller_id").select(
        "product_category_name_english", "seller_id", "order_id",
        F.col("seller_city").alias("city"), F.upper("seller_state").alias("state"),
        "latitude", "longitude", F.round("revenue", 2).alias("total_revenue"),
    )


def _map_ready(fact: DataFrame, keys: list[str], revenue: str) -> DataFrame:
    placed = fact.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    # The fact has one row per order and group, which its checks hold it to, so
    # counting rows counts orders.
    return placed.groupBy(*keys).agg(
        mean(F.col("latitude").cast(COORDINATE)).alias("latitude"),
        mean(F.col("longitude").cast(COORDINATE)).alias("longitude"),
        F.count("order_id").alias("total_orders"),
        F.round(F.sum(revenue), 2).alias("total_revenue_Brazilian_Real"),
    )


def mart_revenue_by_location(fact: DataFrame) -> DataFrame:
    places = fact.withColumnsRenamed({"customer_city": "city", "customer_state": "state"})
    return _map_ready(places, ["city", "state"], "total_order_revenue").orderBy(
        F.desc("total_revenue_Brazilian_Real"), "city", "state"
    )


def mart_seller_by_location(fact: DataFrame) -> DataFrame:
    keys = ["seller_id", "product_category_name_english", "city", "state"]
    return _map_ready(fact, keys, "total_revenue").orderBy(
        F.desc("total_revenue_Brazilian_Real"), *keys[:2]
    )
