"""Presents the test tables as the nine raw marketplace tables.

Every binding is a row-wise projection (the category list is one small
aggregate), so a query over bound tables costs what the same query over real
raw tables would cost: no join, window or sort is added underneath it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import replace
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.params import Params

TEST_PARAMS = replace(
    Params(),
    dataset_start=date(1995, 1, 1),
    dataset_end=date(2001, 12, 31),
    last_complete_month=date(2001, 7, 1),
    trend_start=date(1995, 2, 1),
    cohort_cutoff=date(2000, 6, 30),
    category_min_customers=250,
    state_min_customers=300,
)

# English names given to the bound part types; PROMO stays untranslated.
CATEGORY_NAMES = {
    "economy": "auto",
    "large": "electronics",
    "medium": "baby",
    "small": "food",
    "standard": "drinks",
}


def _text(prefix: str, expression: str):
    return F.expr(f"concat('{prefix}', cast({expression} as string))")


def orders(o: DataFrame) -> DataFrame:
    timed = o.select(
        "o_orderkey",
        F.expr(
            """case o_orderstatus
                 when 'F' then 'delivered'
                 when 'O' then element_at(array('shipped', 'Invoiced\\t', 'processing'), cast(o_orderkey % 3 as int) + 1)
                 else if(o_orderkey % 2 = 0, '\\t canceled', 'unavailable') end"""
        ).alias("order_status"),
        F.expr(
            "cast(o_orderdate as timestamp) + make_dt_interval(0, 0, cast(o_orderkey * 37 % 1440 as int))"
        ).alias("purchase"),
    )
    approved = timed.withColumn(
        "approved",
        F.expr(
            """case when o_orderkey % 41 = 0 then null
                    when o_orderkey % 53 = 0 then purchase - make_dt_interval(0, 1)
                    else purchase + make_dt_interval(0, cast(o_orderkey % 50 as int)) end"""
        ),
    )
    return approved.select(
        _text("o", "o_orderkey").alias("order_id"),
        _text("c", "o_orderkey").alias("customer_id"),
        "order_status",
        F.col("purchase").alias("order_purchase_timestamp"),
        F.col("approved").alias("order_approved_at"),
        F.expr(
            """case when order_status in ('delivered', 'shipped')
                    then approved + make_dt_interval(cast(o_orderkey % 7 as int)) end"""
        ).alias("order_delivered_carrier_date"),
        F.expr(
            """case when order_status = 'delivered' and o_orderkey % 83 <> 0
                    then purchase + make_dt_interval(
                           cast(if(o_orderkey % 9 = 0, o_orderkey % 47, o_orderkey % 25) as int),
                           cast(o_orderkey % 24 as int)) end"""
        ).alias("order_delivered_customer_date"),
        F.expr("date_trunc('DAY', purchase) + make_dt_interval(25)").alias(
            "order_estimated_delivery_date"
        ),
    )


def customers(o: DataFrame) -> DataFrame:
    return o.select(
        F.expr("concat('c', cast(o_orderkey as string), if(o_orderkey % 11 = 0, '\\t', ''))").alias("customer_id"),
        _text("u", "o_custkey * 8 + o_orderkey % 8").alias("customer_unique_id"),
        F.expr("lpad(cast(o_custkey % 400 as string), 5, '0')").alias("customer_zip_code_prefix"),
        _text("\\tCity_", "(o_custkey + o_orderkey % 2) % (1 + o_custkey % 50)").alias("customer_city"),
        _text("nation_", "o_custkey % 25").alias("customer_state"),
    )


def _cents(amount: str) -> str:
    """An amount in cents. `round` writes a double out as text and reads it again;
    `rint` gives the same but halfway between two integers."""
    cents = f"{amount} * 100"
    return f"cast(if(abs({cents} - rint({cents})) = 0.5D, round({cents}), rint({cents})) as bigint)"


def _line_cents(line: DataFrame) -> DataFrame:
    price, tax = _cents("l_extendedprice"), _cents("l_tax")
    return line.select(
        "*",
        F.expr(price).alias("price_cents"),
        F.expr(f"{price} * {tax} div 100").alias("freight_cents"),
        F.expr("(l_partkey * 64 + cast(l_quantity as bigint)) * 8 + l_linenumber").alias("line_id"),
    )


def order_items(line: DataFrame) -> DataFrame:
    return _line_cents(line).select(
        _text("o", "l_orderkey").alias("order_id"),
        F.col("line_id").alias("order_item_id"),
        _text("p", "l_partkey").alias("product_id"),
        _text("s", "l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        F.expr("price_cents / 100.0D").alias("price"),
        F.expr("freight_cents / 100.0D").alias("freight_value"),
    )


def order_payments(line: DataFrame) -> DataFrame:
    """One payment per line, two where part of the line was paid by voucher."""
    due = _line_cents(line).withColumn(
        "due_cents",
        F.expr(
            """price_cents + freight_cents
               + if(l_orderkey % 97 = 0, 5, 0)
               + if(l_orderkey % 89 = 0 and l_linenumber = 1, 1, 0)"""
        ),
    )
    parts = due.withColumn(
        "part",
        F.explode(
            F.expr(
                """if(l_partkey % 10 = 0,
                     array(struct(0L as n, due_cents - 500 as cents), struct(1L as n, 500L as cents)),
                     array(struct(0L as n, due_cents as cents)))"""
            )
        ),
    )
    return parts.select(
        _text("o", "l_orderkey").alias("order_id"),
        F.expr("line_id * 2 + part.n").alias("payment_sequential"),
        F.expr(
            """if(part.n = 1, 'voucher',
                  element_at(array('Credit_Card\\t', 'boleto', 'debit_card', 'not_defined'),
                             cast(l_partkey % 4 as int) + 1))"""
        ).alias("payment_type"),
        F.expr("1 + l_suppkey % 26").alias("payment_installments"),
        F.expr("part.cents / 100.0D").alias("payment_value"),
    )


def order_reviews(events: DataFrame) -> DataFrame:
    return events.select(
        _text("r", "if(event_id % 10 = 0, event_id + 1, event_id)").alias("review_id"),
        _text("o", "event_id * 9 div 10").alias("order_id"),
        F.expr("1 + event_id % 5").alias("review_score"),
        F.expr("if(event_id % 3 = 0, ' \\n\\t', event_type)").alias("review_comment_title"),
        F.expr("if(event_id % 4 = 0, null, props)").alias("review_comment_message"),
        F.col("ts").cast("timestamp").alias("review_creation_date"),
        F.expr(
            """if(event_id % 37 = 0, null,
                  cast(ts as timestamp) + make_dt_interval(0, cast(event_id % 90 as int)))"""
        ).alias("review_answer_timestamp"),
    )


def products(part: DataFrame) -> DataFrame:
    return part.select(
        _text("p", "p_partkey").alias("product_id"),
        F.expr("if(p_size = 1, '', p_type)").alias("product_category_name"),
        F.expr("cast(length(p_name) as bigint)").alias("product_name_lenght"),
        F.expr("cast(p_size * 10 as bigint)").alias("product_description_lenght"),
        F.expr("cast(p_size % 7 as bigint)").alias("product_photos_qty"),
        F.expr("cast(p_size * 100 as bigint)").alias("product_weight_g"),
        F.expr("cast(p_size + 5 as bigint)").alias("product_length_cm"),
        F.expr("cast(p_size + 2 as bigint)").alias("product_height_cm"),
        F.expr("cast(p_size + 3 as bigint)").alias("product_width_cm"),
    )


def product_category_translation(part: DataFrame) -> DataFrame:
    kind = F.lower("p_type")
    english = F.create_map(*[F.lit(x) for pair in CATEGORY_NAMES.items() for x in pair])
    return (
        part.where(kind.isin(*CATEGORY_NAMES))
        .groupBy(F.col("p_type").alias("product_category_name"))
        .agg(F.max(F.upper(F.element_at(english, kind))).alias("product_category_name_english"))
    )


def sellers(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        _text("s", "s_suppkey").alias("seller_id"),
        F.expr("lpad(cast(s_suppkey % 410 as string), 5, '0')").alias("seller_zip_code_prefix"),
        _text("City_", "s_suppkey % 30").alias("seller_city"),
        _text("nation_", "s_nationkey").alias("seller_state"),
    )


def geolocation(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.expr("lpad(cast(c_custkey % 380 as string), 5, '0')").alias("geolocation_zip_code_prefix"),
        F.expr("c_acctbal / 250.0D - 35.0D").alias("geolocation_lat"),
        F.expr("c_acctbal / 200.0D - 76.0D").alias("geolocation_lng"),
        _text("City_", "c_custkey % 50").alias("geolocation_city"),
        _text("nation_", "c_nationkey").alias("geolocation_state"),
    )


def state_regions(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("state"), F.col("r_name").alias("region")
    )


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class BoundTables(Mapping):
    """The raw tables by name, each read and bound when first asked for."""

    _BINDINGS = {
        "customers": (customers, "orders"),
        "orders": (orders, "orders"),
        "order_items": (order_items, "lineitem"),
        "order_payments": (order_payments, "lineitem"),
        "order_reviews": (order_reviews, "events"),
        "products": (products, "part"),
        "sellers": (sellers, "supplier"),
        "geolocation": (geolocation, "customer"),
        "product_category_translation": (product_category_translation, "part"),
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.source = cache(lambda table: read(spark, sf_dir, table))
        self._bound: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._bound:
            bind, table = self._BINDINGS[name]
            self._bound[name] = bind(self.source(table))
        return self._bound[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._BINDINGS)

    def __len__(self) -> int:
        return len(self._BINDINGS)


def raw_tables(spark: SparkSession, sf_dir: str) -> BoundTables:
    return BoundTables(spark, sf_dir)
