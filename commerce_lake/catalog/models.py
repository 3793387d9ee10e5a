"""M1-M28: every model as a query."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from commerce_lake.catalog.common import Query, models, over_models, plain, with_views
from commerce_lake.catalog.views import VIEWS
from commerce_lake.plans import analytics, colocated, history
from commerce_lake.sources.storage import Lake, shared_folder

_MONEY_TOTALS = (
    "payment_value_total", "item_price_total", "freight_value_total", "item_gross_total",
    "payment_difference",
)

# query id -> (model, oracle view, decimal columns compared as doubles)
_MODELS = {
    "M1": ("stg_customers", "stg_customers", ()),
    "M2": ("stg_orders", "stg_orders", ()),
    "M3": ("stg_order_items", "stg_order_items", ("price", "freight_value")),
    "M4": ("stg_order_payments", "stg_order_payments", ("payment_value",)),
    "M5": ("stg_order_reviews", "stg_order_reviews", ()),
    "M6": ("stg_products", "stg_products", ()),
    "M7": ("stg_sellers", "stg_sellers", ()),
    "M8": ("stg_geolocation", "stg_geolocation", ("geolocation_lat", "geolocation_lng")),
    "M9": ("stg_product_category_translation", "stg_translation", ()),
    "M10": ("int_geolocation_deduped", "zip_points", ()),
    "M11": ("int_order_lifecycle", "lifecycle", ()),
    "M12": ("int_order_payment_totals", "order_totals", _MONEY_TOTALS),
    "M13": ("int_customer_order_history", "history", ("lifetime_revenue",)),
    "M14": ("dim_customer", "dim_customer", ("lifetime_revenue",)),
    "M15": ("dim_date", "dim_date", ()),
    "M16": ("dim_product", "dim_product", ()),
    "M17": ("dim_seller", "dim_seller", ()),
    "M18": ("fct_order_items", "fct_order_items", ("price", "freight_value", "line_gross_value")),
    "M19": ("fct_orders", "fct_orders", _MONEY_TOTALS),
    "M20": ("fct_payments", "fct_payments", ("payment_value",)),
    "M21": ("fct_reviews", "fct_reviews", ()),
    "M22": ("geo_dim_geolocation", "geo_zip", ()),
    "M23": ("geo_dim_product", "geo_product", ()),
    "M24": ("fact_sale_order_location", "geo_sales", ("total_order_revenue",)),
    "M25": ("fact_revenue_by_product_seller_location", "geo_seller_sales", ("total_revenue",)),
    "M26": ("mart_revenue_by_location", "geo_places", ("total_revenue_Brazilian_Real",)),
    "M27": ("mart_seller_by_location", "geo_seller_places", ("total_revenue_Brazilian_Real",)),
}


def _oracle(view: str, decimals: tuple[str, ...]) -> str:
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in decimals)
    star = f"* REPLACE ({casts})" if casts else "*"
    return with_views(VIEWS, f"SELECT {star} FROM {view}")


QUERIES: dict[str, Query] = {
    f"{key}_{model}": over_models(lambda m, name=model: getattr(m, name))
    for key, (model, _, _) in _MODELS.items()
}
ORACLES: dict[str, str] = {
    f"{key}_{model}": _oracle(view, decimals) for key, (model, view, decimals) in _MODELS.items()
}

QUERIES["M28_sla_sales"] = over_models(analytics.sla_sales)
ORACLES["M28_sla_sales"] = with_views(
    VIEWS,
    """SELECT o.order_id, o.customer_id, o.order_status, order_purchase_timestamp, order_approved_at,
              order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
              date_sub('second', order_approved_at, order_delivered_carrier_date) AS org_to_carrier_time,
              date_sub('second', order_delivered_carrier_date, order_delivered_customer_date) AS carrier_to_customer_time,
              date_sub('second', order_approved_at, order_delivered_customer_date) AS actual_arrival_time,
              TRUE AS apply_SLA,
              date_sub('second', order_estimated_delivery_date, order_delivered_customer_date) AS delivery_delay,
              order_item_id, i.product_id, seller_id, shipping_limit_date, price, freight_value,
              product_category_name, product_name_lenght, product_description_lenght, product_photos_qty,
              product_weight_g, product_length_cm, product_height_cm, product_width_cm,
              month(order_purchase_timestamp)::INTEGER AS month, year(order_purchase_timestamp)::INTEGER AS year
       FROM raw_orders o JOIN raw_order_items i ON o.order_id = i.order_id
       JOIN raw_products p ON p.product_id = i.product_id
       WHERE order_delivered_customer_date <= order_estimated_delivery_date""",
)


def _by_order(build):
    """Over orders, lines and payments that were stored in buckets of their order before."""

    def run(spark, sf_dir):
        m, lake = models(spark, sf_dir), Lake(f"{shared_folder(spark)}/catalog/by-order-{uuid.uuid4().hex}", "ci")
        colocated.store_by_order(m, lake, buckets=8)
        return plain(build(colocated.opened_by_order(m, lake)))

    return run


QUERIES["M12b_totals_without_a_shuffle"] = _by_order(lambda m: m.int_order_payment_totals)
QUERIES["M18b_lines_without_a_shuffle"] = _by_order(lambda m: m.fct_order_items)
QUERIES["M19b_orders_without_a_shuffle"] = _by_order(lambda m: m.fct_orders)
ORACLES["M12b_totals_without_a_shuffle"] = ORACLES["M12_int_order_payment_totals"]
ORACLES["M18b_lines_without_a_shuffle"] = ORACLES["M18_fct_order_items"]
ORACLES["M19b_orders_without_a_shuffle"] = ORACLES["M19_fct_orders"]


def _folded_history(spark, sf_dir):
    """Histories made without the orders of each year's third month, which are then folded in."""
    m, lake = models(spark, sf_dir), Lake(f"{shared_folder(spark)}/catalog/history-{uuid.uuid4().hex}", "ci")
    month = history.month_of(F.col("order_purchase_timestamp"))
    late = F.coalesce(F.month(month) == 3, F.lit(False))
    before = models(spark, sf_dir)
    before.store("stg_orders", m.stg_orders.where(~late))
    history.store(before, lake)
    months = [r.month for r in m.stg_orders.where(late).select(month.cast("string").alias("month")).distinct().collect()]
    return plain(history.fold_in(m, lake, months))


QUERIES["M13b_history_folded_forward"] = _folded_history
ORACLES["M13b_history_folded_forward"] = ORACLES["M13_int_customer_order_history"]
