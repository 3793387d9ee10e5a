"""The declared checks on raw tables, models and marts, and validations of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.numbers import MONEY, percent_where
from commerce_lake.operators.checks import WARN, Check, evaluate, lost_references
from commerce_lake.operators.shares import in_one_row
from commerce_lake.params import ORDER_STATUSES, PAYMENT_TYPES, Params
from commerce_lake.plans.models import Models


def _key(model: str, column: str) -> list[Check]:
    return [Check("unique", model, (column,)), Check("not_null", model, (column,))]


def _required(model: str, *columns: str) -> list[Check]:
    return [Check("not_null", model, (c,)) for c in columns]


def _refers(model: str, column: str, parent: str, parent_column: str) -> Check:
    return Check("relationships", model, (column,), (parent, parent_column))


def _true(model: str, column: str, expression: str) -> Check:
    return Check("expression_is_true", model, (column,), expression)


def declared_checks(params: Params) -> list[Check]:
    first, last = params.dataset_start, params.dataset_end
    steps = (
        ("order_approved_at", "order_purchase_timestamp"),
        ("order_delivered_carrier_date", "order_approved_at"),
        ("order_delivered_customer_date", "order_delivered_carrier_date"),
    )
    return [
        # Raw tables.
        *_key("customers", "customer_id"),
        *_required("customers", "customer_unique_id"),
        *_key("orders", "order_id"),
        # Staging.
        *_key("stg_customers", "customer_id"),
        *_required("stg_customers", "customer_unique_id"),
        *_key("stg_orders", "order_id"),
        *_required("stg_orders", "customer_id"),
        _refers("stg_orders", "customer_id", "stg_customers", "customer_id"),
        Check("accepted_values", "stg_orders", ("order_status",), ORDER_STATUSES),
        *_required("stg_order_items", "order_id"),
        _refers("stg_order_items", "order_id", "stg_orders", "order_id"),
        _true("stg_order_items", "price", "price >= 0"),
        _true("stg_order_items", "freight_value", "freight_value >= 0"),
        Check("unique_combination", "stg_order_items", ("order_id", "order_item_id")),
        Check("accepted_values", "stg_order_payments", ("payment_type",), PAYMENT_TYPES),
        Check("unique_combination", "stg_order_payments", ("order_id", "payment_sequential")),
        *_key("stg_order_reviews", "review_id"),
        _true("stg_order_reviews", "review_score", "review_score between 1 and 5"),
        *_key("stg_products", "product_id"),
        *_key("stg_sellers", "seller_id"),
        *_required("stg_geolocation", "geolocation_zip_code_prefix"),
        *_key("stg_product_category_translation", "product_category_name"),
        # Intermediate.
        *_key("int_geolocation_deduped", "geolocation_zip_code_prefix"),
        *[Check("pair_a_at_least_b", "int_order_lifecycle", pair, severity=WARN) for pair in steps],
        *_key("int_order_lifecycle", "order_id"),
        *_key("int_order_payment_totals", "order_id"),
        *_key("int_customer_order_history", "customer_unique_id"),
        # Dimensions.
        *_key("dim_date", "date_key"),
        *_key("dim_customer", "customer_key"),
        Check("fewer_rows_than", "dim_customer", (), "fct_orders"),
        *_key("dim_product", "product_key"),
        *_required("dim_product", "product_category_name_english"),
        *_key("dim_seller", "seller_key"),
        # Facts.
        *_required("fct_order_items", "order_id", "customer_key"),
        _refers("fct_order_items", "customer_key", "dim_customer", "customer_key"),
        _refers("fct_order_items", "product_key", "dim_product", "product_key"),
        _refers("fct_order_items", "seller_key", "dim_seller", "seller_key"),
        _true("fct_order_items", "price", "price >= 0"),
        _true("fct_order_items", "freight_value", "freight_value >= 0"),
        Check("unique_combination", "fct_order_items", ("order_id", "order_item_id")),
        Check("row_count_between", "fct_orders", (), params.order_count_band),
        *_key("fct_orders", "order_id"),
        *_required("fct_orders", "customer_key"),
        _refers("fct_orders", "customer_key", "dim_customer", "customer_key"),
        Check("accepted_values", "fct_orders", ("order_status",), ORDER_STATUSES),
        Check("expect_not_null", "fct_orders", ("order_purchase_date",)),
        Check("expect_between", "fct_orders", ("order_purchase_date",), (first, last)),
        *_required("fct_payments", "order_id"),
        _refers("fct_payments", "order_id", "fct_orders", "order_id"),
        Check("accepted_values", "fct_payments", ("payment_type",), PAYMENT_TYPES),
        Check("expect_between", "fct_payments", ("payment_value",), (0, None)),
        Check("expect_between", "fct_payments", ("payment_installments",), params.installment_band, WARN),
        Check("unique_combination", "fct_payments", ("order_id", "payment_sequential")),
        *_key("fct_reviews", "review_id"),
        _refers("fct_reviews", "order_id", "fct_orders", "order_id"),
        _true("fct_reviews", "review_score", "review_score between 1 and 5"),
        Check("expect_in_set", "fct_reviews", ("review_score",), (1, 2, 3, 4, 5)),
        Check("expect_not_null", "fct_reviews", ("review_creation_date",)),
    ]


def location_checks() -> list[Check]:
    return _key("geo_dim_product", "product_id")


class ModelTables(dict):
    """Looks a table up among the raw tables, then among the models."""

    def __init__(self, m: Models):
        super().__init__()
        self._models = m

    def __missing__(self, name: str) -> DataFrame:
        raw = self._models.raw
        return raw[name] if name in raw else getattr(self._models, name)


def run_checks(m: Models, *kinds: str) -> DataFrame:
    checks = [c for c in declared_checks(m.params) if not kinds or c.kind in kinds]
    return evaluate(ModelTables(m), checks)


# Validations of the finished star ----------------------------------------


def row_counts_against_raw(m: Models) -> DataFrame:
    """Fact rows beside the rows of their source: no fan-out, no drops."""
    pairs = {
        "fct_order_items": (m.raw["order_items"], m.fct_order_items, F.count("*")),
        "fct_orders": (m.raw["orders"], m.fct_orders, F.count("*")),
        "fct_payments": (m.raw["order_payments"], m.fct_payments, F.count("*")),
        "fct_reviews": (m.raw["order_reviews"], m.fct_reviews, F.countDistinct("review_id")),
    }
    counts = in_one_row(
        *[raw.agg(source.alias(f"raw_{name}")) for name, (raw, _, source) in pairs.items()],
        *[mart.agg(F.count("*").alias(f"mart_{name}")) for name, (_, mart, _) in pairs.items()],
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("model"),
                        F.col(f"raw_{name}").alias("raw_rows"),
                        F.col(f"mart_{name}").alias("mart_rows"),
                        (F.col(f"raw_{name}") == F.col(f"mart_{name}")).alias("matches"),
                    )
                    for name in pairs
                ]
            )
        )
    )


def control_totals(m: Models) -> DataFrame:
    """Additive measures of the marts beside the same sums over raw tables."""

    def total(df: DataFrame, column: str, side: str) -> DataFrame:
        return df.agg(F.sum(F.col(column).cast(MONEY)).alias(f"{side}_{column}"))

    sources = {
        "price": (m.raw["order_items"], m.fct_order_items),
        "freight_value": (m.raw["order_items"], m.fct_order_items),
        "payment_value": (m.raw["order_payments"], m.fct_payments),
    }
    sums = in_one_row(
        *[total(raw, c, "raw") for c, (raw, _) in sources.items()],
        *[total(mart, c, "mart") for c, (_, mart) in sources.items()],
    )
    rows = [
        F.struct(
            F.lit(c).alias("measure"),
            F.col(f"raw_{c}").alias("raw_total"),
            F.col(f"mart_{c}").alias("mart_total"),
            (F.col(f"raw_{c}") == F.col(f"mart_{c}")).alias("matches"),
        )
        for c in sources
    ]
    return sums.select(F.inline(F.array(*rows)))


def rollup_mismatches(m: Models) -> DataFrame:
    """Orders whose stored totals differ from their lines or payments."""
    lines = m.fct_order_items.groupBy("order_id").agg(
        F.sum("line_gross_value").alias("gross"), F.count("*").alias("lines")
    )
    paid = m.fct_payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    stored = m.fct_orders.select("order_id", "item_gross_total", "item_count", "payment_value_total")
    joined = stored.join(lines, "order_id", "full").join(paid, "order_id", "full")

    def differs(left: str, right: str):
        return F.coalesce(F.col(left), F.lit(0)) != F.coalesce(F.col(right), F.lit(0))

    return joined.agg(
        F.count("*").alias("orders"),
        F.count_if(differs("item_gross_total", "gross")).alias("gross_mismatches"),
        F.count_if(differs("item_count", "lines")).alias("line_count_mismatches"),
        F.count_if(differs("payment_value_total", "paid")).alias("payment_mismatches"),
    )


def orphan_counts(m: Models) -> DataFrame:
    """Fact rows whose key is missing from its dimension, per foreign key."""
    keys = [c for c in declared_checks(m.params) if c.kind == "relationships" and c.model.startswith("fct_")]
    rows = [
        F.struct(F.lit(c.model).alias("model"), F.lit(c.columns[0]).alias("key"), F.col(f"lost_{place}").alias("orphans"))
        for place, c in enumerate(keys)
    ]
    return lost_references(ModelTables(m), keys).select(F.inline(F.array(*rows)))


def date_coverage(m: Models) -> DataFrame:
    """Calendar without gaps, and purchase days that it lacks."""
    days = m.dim_date.agg(
        F.count("*").alias("days"),
        (F.datediff(F.max("date_key"), F.min("date_key")) + 1).cast("bigint").alias("span_days"),
    )
    missing = (
        m.fct_orders.select(F.col("order_purchase_date").alias("date_key"))
        .distinct()
        .join(m.dim_date, "date_key", "left_anti")
        .agg(F.count("*").alias("missing_days"))
    )
    return in_one_row(days, missing).select(
        "days", "span_days", (F.col("days") == F.col("span_days")).alias("contiguous"), "missing_days"
    )


def known_gaps(m: Models) -> DataFrame:
    """Rows kept on purpose although something about them is missing."""
    return in_one_row(
        m.fct_orders.agg(F.count_if(F.col("item_count") == 0).alias("orders_without_items")),
        m.dim_customer.agg(F.count_if(F.col("customer_latitude").isNull()).alias("customers_without_point")),
        m.dim_seller.agg(F.count_if(F.col("seller_latitude").isNull()).alias("sellers_without_point")),
        m.dim_product.agg(
            F.count_if(F.col("product_category_name_english") == "unknown").alias("unknown_products")
        ),
        m.dim_customer.agg(
            F.count_if(F.col("is_repeat_customer")).alias("repeat_by_delivered"),
            F.count_if(F.col("order_count") > 1).alias("repeat_by_placed"),
        ),
    )


def reconciliation_rate(m: Models) -> DataFrame:
    reconciled = F.col("is_payment_reconciled")
    return m.int_order_payment_totals.agg(
        F.count("*").alias("orders"),
        F.count_if(reconciled).alias("reconciled_orders"),
        percent_where(reconciled, 2).alias("reconciled_pct"),
    )
