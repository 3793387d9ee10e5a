"""Orders, lines and payments stored in buckets of their order.

Facts that meet on order_id are written once, hashed into the same number of
buckets, one file a bucket, sorted by order. Whatever joins or sums them by
order afterwards moves no row: a task reads the same bucket of each table. The
bucket count is that of the rows of the largest table over BUCKET_ROWS, so that
a task's share stays the same however large the tables are, and is kept with the
table, so that a later session opens it in the same way.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lake.plans.models import Models
from commerce_lake.sources import versions
from commerce_lake.sources.storage import Lake

KEY = "order_id"
LAYER = "by_order"
#: Models with one or more rows per order, as everything made by order needs them.
TABLES = ("int_order_lifecycle", "stg_order_items", "stg_order_payments")
#: Rows of the largest table that a bucket holds on average; a task sorts and sums
#: a bucket of each table.
BUCKET_ROWS = 500_000
LAYOUT = "folder string, key string, buckets int, schema string"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Publish a table hashed into buckets by `key`, and open it."""
    spark, folder = df.sparkSession, versions.new_folder(path)
    # Dealt as buckets are, so that every task writes one file.
    dealt = df.repartition(buckets, key)
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", folder).format("parquet").saveAsTable(name)
    layout = spark.range(0, 1, 1, 1).select(
        F.lit(folder).alias("folder"), F.lit(key).alias("key"), F.lit(buckets).alias("buckets"),
        F.lit(df.schema.json()).alias("schema"),
    )
    layout.write.mode("append").parquet(f"{path.rstrip('/')}/_layouts")
    versions.log(spark, path, folder)
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A published table with its buckets known to the planner, in any session."""
    found = versions.versions(spark, path)
    if not found:
        raise LookupError(f"nothing has been published at {path}")
    folder = found[-1].folder
    layout = spark.read.schema(LAYOUT).parquet(f"{path.rstrip('/')}/_layouts").where(F.col("folder") == folder).first()
    schema = StructType.fromJson(json.loads(layout.schema))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout.key}`) "
        f"SORTED BY (`{layout.key}`) INTO {layout.buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name)


def enough_buckets(m: Models, least: int) -> int:
    """`least`, or as many as the largest table needs. Staging rows are counted,
    which reads hardly a column; the lifecycle has as many rows as its orders."""
    rows = max(df.count() for df in (m.stg_orders, m.stg_order_items, m.stg_order_payments))
    return max(least, -(-rows // BUCKET_ROWS))


def store_by_order(m: Models, lake: Lake, buckets: int) -> None:
    """Write the tables of orders, lines and payments, all with the same buckets:
    as many as asked for, or more where the tables are large."""
    buckets = enough_buckets(m, buckets)
    for name in TABLES:
        write_bucketed(getattr(m, name), lake.path(LAYER, name), KEY, buckets)


def opened_by_order(m: Models, lake: Lake) -> Models:
    """The same models over the stored tables: facts and totals by order need no shuffle."""
    stored = {name: open_bucketed(m.spark, lake.path(LAYER, name)) for name in TABLES}
    opened = type(m)(m.raw, m.params, stored)
    # Order totals are made from the orders at hand, which lie in the same buckets.
    opened.store("stg_orders", stored["int_order_lifecycle"].select("order_id", "order_status", "order_purchase_timestamp"))
    return opened
