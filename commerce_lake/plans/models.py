"""The model graph: every model is a lazy DataFrame, built on first use."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions import labels
from commerce_lake.params import Params
from commerce_lake.plans import geo, intermediate, marts, staging


class Models:
    """Models over nine raw tables.

    `stored` replaces models by tables already written, so a build reads each
    finished model from storage instead of recomputing it. Where order totals
    are stored, the models that need them join the table; otherwise they sum
    payments and lines straight onto their own orders, which spares a scan and
    a shuffle of the orders behind the totals. Order totals sum the payments of
    the stored fact, which holds every cleaned payment in the order of its key.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        params: Params | None = None,
        stored: Mapping[str, DataFrame] | None = None,
    ):
        self.raw = raw
        self.params = params or Params()
        self.stored: set[str] = set()
        for name, df in (stored or {}).items():
            self.store(name, df)

    def store(self, name: str, df: DataFrame) -> None:
        self.__dict__[name] = df
        self.stored.add(name)

    @property
    def spark(self):
        return self.raw["orders"].sparkSession

    @cached_property
    def state_regions(self) -> DataFrame:
        return labels.state_regions(self.spark)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw["order_payments"])

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw["order_reviews"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"])

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw["sellers"])

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw["geolocation"])

    @cached_property
    def stg_product_category_translation(self) -> DataFrame:
        return staging.stg_product_category_translation(self.raw["product_category_translation"])

    @cached_property
    def int_geolocation_deduped(self) -> DataFrame:
        return intermediate.int_geolocation_deduped(self.stg_geolocation, self.params)

    @cached_property
    def int_order_lifecycle(self) -> DataFrame:
        return intermediate.int_order_lifecycle(self.stg_orders, self.stg_customers, self.params)

    @cached_property
    def int_order_payment_totals(self) -> DataFrame:
        payments = self.fct_payments if "fct_payments" in self.stored else self.stg_order_payments
        return intermediate.int_order_payment_totals(self.stg_orders, payments, self.stg_order_items, self.params)

    @cached_property
    def int_customer_order_history(self) -> DataFrame:
        totals_are_stored = "int_order_payment_totals" in self.stored
        return intermediate.int_customer_order_history(
            self.stg_customers,
            self.stg_orders,
            self.int_order_payment_totals
            if totals_are_stored
            else intermediate.payment_totals(self.stg_order_payments),
            self.params,
        )

    @cached_property
    def _zip_points(self) -> DataFrame:
        """Points of known zips. Stating that they are known before the medians
        keeps both passes of the medians alike, so they share scan and shuffle."""
        if "int_geolocation_deduped" in self.stored:
            return self.int_geolocation_deduped
        known = self.stg_geolocation.where(F.col("geolocation_zip_code_prefix").isNotNull())
        return intermediate.int_geolocation_deduped(known, self.params)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return marts.dim_customer(self.int_customer_order_history, self._zip_points)

    @cached_property
    def dim_date(self) -> DataFrame:
        spine = marts.date_spine(self.spark, self.params.dataset_start, self.params.dataset_end)
        return marts.dim_date(spine, self.params)

    @cached_property
    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.stg_products, self.stg_product_category_translation)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return marts.dim_seller(self.stg_sellers, self._zip_points)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return marts.fct_order_items(self.stg_order_items, self.int_order_lifecycle)

    @cached_property
    def fct_orders(self) -> DataFrame:
        if "int_order_payment_totals" in self.stored:
            totals = self.int_order_lifecycle.join(self.int_order_payment_totals, "order_id", "left")
        else:
            totals = intermediate.with_order_totals(
                self.int_order_lifecycle, self.stg_order_payments, self.stg_order_items, self.params
            )
        return marts.fct_orders(totals)

    @cached_property
    def fct_payments(self) -> DataFrame:
        return marts.fct_payments(self.stg_order_payments)

    @cached_property
    def fct_reviews(self) -> DataFrame:
        return marts.fct_reviews(self.stg_order_reviews)

    @cached_property
    def geo_dim_geolocation(self) -> DataFrame:
        return geo.geo_dim_geolocation(self.raw["geolocation"])

    @cached_property
    def geo_dim_product(self) -> DataFrame:
        return geo.geo_dim_product(self.raw["products"], self.raw["product_category_translation"])

    @cached_property
    def fact_sale_order_location(self) -> DataFrame:
        return geo.fact_sale_order_location(
            self.raw["orders"], self.raw["customers"], self.raw["order_payments"],
            self.geo_dim_geolocation,
        )

    @cached_property
    def fact_revenue_by_product_seller_location(self) -> DataFrame:
        return geo.fact_revenue_by_product_seller_location(
            self.raw["order_items"], self.raw["orders"], self.geo_dim_product,
            self.raw["sellers"], self.geo_dim_geolocation,
        )

    @cached_property
    def mart_revenue_by_location(self) -> DataFrame:
        return geo.mart_revenue_by_location(self.fact_sale_order_location)

    @cached_property
    def mart_seller_by_location(self) -> DataFrame:
        return geo.mart_seller_by_location(self.fact_revenue_by_product_seller_location)
