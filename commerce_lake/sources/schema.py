"""Declared schemas of the raw tables: fixed, never inferred.

A declaration lists each table's file and its columns, as pairs or a mapping in
file order, with one of four types. All raw columns are nullable; required values are checked later.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql.types import (
    DataType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

TYPES: dict[str, DataType] = {
    "text": StringType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
}
_ENTRY_KEYS = {"table", "file", "columns", "free_text"}


class DeclarationError(ValueError):
    """A schema declaration that names something unknown or twice."""


@dataclass(frozen=True)
class RawTable:
    name: str
    file: str
    columns: tuple[tuple[str, str], ...]
    # Values may hold line breaks, so a file cannot be split between tasks.
    free_text: bool = False

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c, TYPES[t], nullable=True) for c, t in self.columns])


def declare(entries: Sequence[Mapping]) -> dict[str, RawTable]:
    """Validate declarations before anything is read."""
    tables: dict[str, RawTable] = {}
    for position, entry in enumerate(entries):
        unknown = sorted(set(entry) - _ENTRY_KEYS)
        if unknown:
            raise DeclarationError(f"entry {position}: unknown key(s) {', '.join(unknown)}")
        for key in ("table", "file", "columns"):
            if not entry.get(key):
                raise DeclarationError(f"entry {position}: `{key}` is missing or empty")
        name = entry["table"]
        if name in tables:
            raise DeclarationError(f"table `{name}` is declared twice")
        columns = list(entry["columns"].items() if isinstance(entry["columns"], Mapping) else entry["columns"])
        for column, kind in columns:
            if [c for c, _ in columns].count(column) > 1:
                raise DeclarationError(f"`{name}.{column}` is declared twice")
            if kind not in TYPES:
                raise DeclarationError(
                    f"`{name}.{column}` has unknown type {kind!r}; known: {', '.join(sorted(TYPES))}"
                )
        tables[name] = RawTable(
            name, entry["file"], tuple(columns), bool(entry.get("free_text", False))
        )
    return tables


def with_file_prefix(tables: Mapping[str, RawTable], prefix: str) -> dict[str, RawTable]:
    """The same tables under data set names that start with a publisher's prefix.

    Lookup files, which are not called a data set, keep their names.
    """
    return {
        name: replace(table, file=prefix + table.file) if table.file.endswith("_dataset.csv") else table
        for name, table in tables.items()
    }


# The nine raw files and their 52 columns in file order.
RAW_TABLES = declare(
    [
        {
            "table": "customers",
            "file": "customers_dataset.csv",
            "columns": [
                ("customer_id", "text"),
                ("customer_unique_id", "text"),
                ("customer_zip_code_prefix", "text"),
                ("customer_city", "text"),
                ("customer_state", "text"),
            ],
        },
        {
            "table": "orders",
            "file": "orders_dataset.csv",
            "columns": [
                ("order_id", "text"),
                ("customer_id", "text"),
                ("order_status", "text"),
                ("order_purchase_timestamp", "timestamp"),
                ("order_approved_at", "timestamp"),
                ("order_delivered_carrier_date", "timestamp"),
                ("order_delivered_customer_date", "timestamp"),
                ("order_estimated_delivery_date", "timestamp"),
            ],
        },
        {
            "table": "order_items",
            "file": "order_items_dataset.csv",
            "columns": [
                ("order_id", "text"),
                ("order_item_id", "bigint"),
                ("product_id", "text"),
                ("seller_id", "text"),
                ("shipping_limit_date", "timestamp"),
                ("price", "double"),
                ("freight_value", "double"),
            ],
        },
        {
            "table": "order_payments",
            "file": "order_payments_dataset.csv",
            "columns": [
                ("order_id", "text"),
                ("payment_sequential", "bigint"),
                ("payment_type", "text"),
                ("payment_installments", "bigint"),
                ("payment_value", "double"),
            ],
        },
        {
            "table": "order_reviews",
            "file": "order_reviews_dataset.csv",
            "columns": [
                ("review_id", "text"),
                ("order_id", "text"),
                ("review_score", "bigint"),
                ("review_comment_title", "text"),
                ("review_comment_message", "text"),
                ("review_creation_date", "timestamp"),
                ("review_answer_timestamp", "timestamp"),
            ],
            "free_text": True,
        },
        {
            "table": "products",
            "file": "products_dataset.csv",
            "columns": [
                ("product_id", "text"),
                ("product_category_name", "text"),
                ("product_name_lenght", "bigint"),
                ("product_description_lenght", "bigint"),
                ("product_photos_qty", "bigint"),
                ("product_weight_g", "bigint"),
                ("product_length_cm", "bigint"),
                ("product_height_cm", "bigint"),
                ("product_width_cm", "bigint"),
            ],
        },
        {
            "table": "sellers",
            "file": "sellers_dataset.csv",
            "columns": [
                ("seller_id", "text"),
                ("seller_zip_code_prefix", "text"),
                ("seller_city", "text"),
                ("seller_state", "text"),
            ],
        },
        {
            "table": "geolocation",
            "file": "geolocation_dataset.csv",
            "columns": [
                ("geolocation_zip_code_prefix", "text"),
                ("geolocation_lat", "double"),
                ("geolocation_lng", "double"),
                ("geolocation_city", "text"),
                ("geolocation_state", "text"),
            ],
        },
        {
            "table": "product_category_translation",
            "file": "product_category_name_translation.csv",
            "columns": [
                ("product_category_name", "text"),
                ("product_category_name_english", "text"),
            ],
        },
    ]
)
