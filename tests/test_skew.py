"""A third of all rows under one order, customer, product, review and zip.

Results must be whole and must not depend on how Spark spreads the work.
"""

import pytest
from pyspark.sql import functions as F

from commerce_lake.operators.percentiles import exact_percentiles
from commerce_lake.params import Params
from commerce_lake.plans import analytics, quality
from commerce_lake.plans.models import Models
from commerce_lake.sources.schema import RAW_TABLES

ROWS = 30_000
TINY_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


def _hot(prefix: str, spread: int) -> str:
    return f"concat('{prefix}', if(id % 3 = 0, 0, 1 + id % {spread}))"


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(0, ROWS, 1, 8)
    orders = spark.range(0, 3000, 1, 4)
    raw = {
        "orders": orders.selectExpr(
            "concat('o', id) order_id", "concat('c', id) customer_id", "'delivered' order_status",
            "timestamp'2017-01-01' + make_dt_interval(cast(id % 500 as int)) order_purchase_timestamp",
            "cast(null as timestamp) order_approved_at", "cast(null as timestamp) order_delivered_carrier_date",
            "timestamp'2017-01-05' + make_dt_interval(cast(id % 530 as int)) order_delivered_customer_date",
            "timestamp'2017-01-25' + make_dt_interval(cast(id % 500 as int)) order_estimated_delivery_date",
        ),
        "customers": orders.selectExpr(
            "concat('c', id) customer_id", f"{_hot('u', 900)} customer_unique_id",
            f"{_hot('z', 40)} customer_zip_code_prefix", f"{_hot('city', 60)} customer_city", "'SP' customer_state",
        ),
        "order_items": ids.selectExpr(
            f"{_hot('o', 2900)} order_id", "id order_item_id", f"{_hot('p', 300)} product_id",
            f"{_hot('s', 50)} seller_id", "timestamp'2017-01-09' shipping_limit_date",
            "cast(id % 97 as double) price", "cast(id % 7 as double) freight_value",
        ),
        "order_payments": ids.selectExpr(
            f"{_hot('o', 2900)} order_id", "id payment_sequential", "'boleto' payment_type",
            "1L payment_installments", "cast(id % 97 + id % 7 as double) payment_value",
        ),
        "order_reviews": ids.selectExpr(
            f"{_hot('r', 9000)} review_id", f"{_hot('o', 2900)} order_id", "1 + id % 5 review_score",
            "cast(null as string) review_comment_title", "'m' review_comment_message",
            "timestamp'2017-02-01' review_creation_date",
            "timestamp'2017-02-01' + make_dt_interval(0, cast(id % 50 as int)) review_answer_timestamp",
        ),
        "products": spark.range(301).selectExpr(
            "concat('p', id) product_id", "concat('k', id % 5) product_category_name",
            *[f"1L {c}" for c, _ in RAW_TABLES["products"].columns[2:]],
        ),
        "sellers": spark.range(51).selectExpr(
            "concat('s', id) seller_id", "concat('z', id % 40) seller_zip_code_prefix", "'x' seller_city", "'SP' seller_state"
        ),
        "geolocation": ids.selectExpr(
            f"{_hot('z', 40)} geolocation_zip_code_prefix", "-20 - (id % 1000) / 100.0D geolocation_lat",
            "-40 - (id % 777) / 100.0D geolocation_lng", "'x' geolocation_city", "'SP' geolocation_state",
        ),
        "product_category_translation": spark.range(4).selectExpr(
            "concat('k', id) product_category_name", "element_at(array('auto','food','baby','toys'), cast(id as int) + 1) product_category_name_english"
        ),
    }
    # A new graph per call: a DataFrame keeps the plan of its first run.
    return lambda: Models(raw, Params(category_min_customers=1, state_min_customers=1))


QUERIES = [
    lambda m: m.stg_order_reviews,
    lambda m: m.int_geolocation_deduped,
    lambda m: m.int_order_payment_totals,
    lambda m: m.dim_customer,
    lambda m: m.fct_order_items,
    lambda m: m.mart_seller_by_location,
    analytics.reviews_by_lateness,
    analytics.repeat_rate_by_first_category,
    analytics.top_cities,
    analytics.revenue_by_category_and_city,
    quality.rollup_mismatches,
]


@pytest.mark.parametrize("build", QUERIES)
def test_results_do_not_depend_on_the_physical_plan(spark, skewed, build):
    usual = sorted(map(str, build(skewed()).collect()))
    for key, value in TINY_SKEW.items():
        spark.conf.set(key, value)
    try:
        split = sorted(map(str, build(skewed()).collect()))
    finally:
        for key in TINY_SKEW:
            spark.conf.unset(key)
    assert split == usual and usual


def test_hot_order_is_split_and_kept_whole(spark, skewed):
    for key, value in TINY_SKEW.items():
        spark.conf.set(key, value)
    try:
        items = skewed().fct_order_items
        rows = items.collect()
        plan = items._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in TINY_SKEW:
            spark.conf.unset(key)
    assert len(rows) == ROWS
    assert sum(r.order_id == "o0" for r in rows) == ROWS // 3
    assert "skew=true" in plan


def test_hot_zip_median_is_exact(spark, skewed):
    points = {r.geolocation_zip_code_prefix: r for r in skewed().int_geolocation_deduped.collect()}
    rows = skewed().stg_geolocation.groupBy("geolocation_zip_code_prefix").agg(
        F.percentile(F.col("geolocation_lat").cast("double"), 0.5).alias("lat")
    )
    for row in rows.collect():
        assert abs(points[row[0]].geolocation_lat - row.lat) < 1e-9


def test_no_slice_or_value_list_grows_with_the_rows(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") % 1000).cast("double").alias("v"))
    assert exact_percentiles(df, ["k"], "v", [0.5], 10.0).first().p0 == 499.5
