"""S1-S24: scans, snapshots, loads and table layouts over whole bound tables.

Each query writes the bound test table into the shared folder the session
names, reads it back through the source or sink under test and summarises it.
"""

from __future__ import annotations

import re
import uuid
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.bindings import raw_tables, read
from commerce_lake.catalog.common import Query, models, plain, with_views
from commerce_lake.catalog.views import VIEWS
from commerce_lake.functions.numbers import MONEY
from commerce_lake.plans import analytics
from commerce_lake.plans.marts import spine_covering
from commerce_lake.sources import landing, versions
from commerce_lake.sources.contract import ContractError, location, missing_files, refusing, scan
from commerce_lake.sources.findings import findings
from commerce_lake.sources.schema import RAW_TABLES
from commerce_lake.sources.storage import (
    Lake, publish, refresh_days, replace_days, shared_folder, to_client, write_clustered, write_json_records,
    write_partitioned, write_table,
)
from commerce_lake.sources.zorder import write_zordered

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_PAIR = {name: RAW_TABLES[name] for name in ("customers", "orders")}
_STAMP = datetime(2024, 2, 1, 12)


def _add(name: str, sql: str):
    def wrap(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # A folder per run: sessions do not meet, and logs start empty.
            folder = f"{shared_folder(spark)}/catalog/{name}-{uuid.uuid4().hex}"
            return plain(build(spark, sf_dir, folder))

        QUERIES[name] = run
        ORACLES[name] = with_views(VIEWS, sql)
        return build

    return wrap


def _offer(df: DataFrame, folder: str, table: str) -> None:
    """Put a table into a folder as the CSV file it is declared to come from."""
    path = location(folder, RAW_TABLES[table])
    df.write.mode("overwrite").options(
        header="true", escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)


def _count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def _rescanned(spark: SparkSession, sf_dir: str, folder: str, table: str) -> DataFrame:
    _offer(raw_tables(spark, sf_dir)[table], folder, table)
    return scan(spark, folder, RAW_TABLES[table])


@_add("S1_csv_scan", """
    SELECT seller_id, count(*) AS n, sum(price::DECIMAL(18,2))::DOUBLE AS price, max(shipping_limit_date) AS last_limit
    FROM raw_order_items GROUP BY 1""")
def _(spark, sf_dir, folder):
    return _rescanned(spark, sf_dir, folder, "order_items").groupBy("seller_id").agg(
        F.count("*").alias("n"), F.sum(F.col("price").cast(MONEY)).alias("price"),
        F.max("shipping_limit_date").alias("last_limit"),
    )


@_add("S1b_csv_scan_free_text", """
    SELECT review_score, count(*) AS n, count(message) AS messages, sum(length(message))::BIGINT AS characters
    FROM (SELECT 1 + event_id % 5 AS review_score,
                 CASE WHEN event_id % 4 <> 0 THEN props || chr(10) || '"' || event_type || '", again' END AS message FROM events)
    GROUP BY 1""")
def _(spark, sf_dir, folder):
    reviews = raw_tables(spark, sf_dir)["order_reviews"]
    events = read(spark, sf_dir, "events")
    message = F.concat("props", F.lit("\n\""), "event_type", F.lit("\", again"))
    kept = events.select(
        F.col("event_id").cast("string").alias("review_id"), F.lit("o1").alias("order_id"),
        F.expr("1 + event_id % 5").alias("review_score"), F.lit(None).cast("string").alias("review_comment_title"),
        F.when(F.col("event_id") % 4 != 0, message).alias("review_comment_message"),
        F.col("ts").cast("timestamp").alias("review_creation_date"),
        F.lit(None).cast("timestamp").alias("review_answer_timestamp"),
    )
    _offer(kept.select(*reviews.columns), folder, "order_reviews")
    text = F.col("review_comment_message")
    return scan(spark, folder, RAW_TABLES["order_reviews"]).groupBy("review_score").agg(
        F.count("*").alias("n"), F.count(text).alias("messages"),
        F.sum(F.length(text)).alias("characters"),
    )


@_add("S2_declared_schema", """
    SELECT column_name, 'string' AS type, filled FROM (
      SELECT count(customer_id) AS customer_id, count(customer_unique_id) AS customer_unique_id,
             count(customer_zip_code_prefix) AS customer_zip_code_prefix, count(customer_city) AS customer_city,
             count(customer_state) AS customer_state FROM raw_customers)
    UNPIVOT (filled FOR column_name IN (customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state))""")
def _(spark, sf_dir, folder):
    customers = _rescanned(spark, sf_dir, folder, "customers")
    filled = customers.agg(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                    F.count(f.name).alias("filled"),
                )
                for f in customers.schema.fields
            ]
        ).alias("rows")
    )
    return filled.select(F.inline("rows"))


def _refusal(table: str, read) -> str:
    """What a contract says against a read: its message without the file's path."""
    try:
        with refusing(RAW_TABLES[table]):
            read()
        return "none"
    except ContractError as error:
        return re.split(r" in (?:[a-z][a-z0-9+.-]*:)?/", str(error))[0]


def _append(df: DataFrame, folder: str, table: str) -> None:
    """One more part file of a table."""
    df.coalesce(1).write.mode("append").options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(location(folder, RAW_TABLES[table]))


@_add("S3_column_freeze", """
    SELECT n AS offered, offer, refused FROM (SELECT count(*) AS n FROM orders), (
      SELECT 'every part has an extra column' AS offer, TRUE AS refused
      UNION ALL SELECT 'one part has an extra column', TRUE
      UNION ALL SELECT 'one part has another column', TRUE
      UNION ALL SELECT 'one part is reordered', TRUE
      UNION ALL SELECT 'landing a reordered part', TRUE
      UNION ALL SELECT 'as declared', FALSE)""")
def _(spark, sf_dir, folder):
    customers = raw_tables(spark, sf_dir)["customers"]
    *first, city, state = customers.columns
    extra = customers.withColumn("loyalty_tier", F.lit("gold"))
    few = customers.limit(3)
    parts = {
        "one part has an extra column": few.withColumn("loyalty_tier", F.lit("gold")),
        "one part has another column": few.withColumnRenamed(state, "loyalty_tier"),
        "one part is reordered": few.select(*first, state, city),
        "as declared": few.limit(0),
    }
    said = []
    _offer(extra, f"{folder}/wide", "customers")
    said.append(("every part has an extra column", _refusal("customers", lambda: scan(spark, f"{folder}/wide", RAW_TABLES["customers"]))))
    for k, (offer, later) in enumerate(parts.items()):
        place = f"{folder}/{k}"
        _offer(customers, place, "customers")
        _append(later, place, "customers")
        # One column is asked for; all are checked.
        said.append((offer, _refusal("customers", lambda p=place: scan(spark, p, RAW_TABLES["customers"]).agg(F.max("customer_id")).collect())))
    only = {"customers": RAW_TABLES["customers"]}
    landed = _refusal("customers", lambda: landing.land(spark, f"{folder}/2", f"{folder}/zone", date(2024, 1, 1), _STAMP, only))
    said.append(("landing a reordered part", landed))
    offered = customers.agg(F.count("*").alias("offered"))
    # A refusal names the file; which part it names depends on the listing.
    refused = [(offer, text.startswith("customers_dataset.csv: ")) for offer, text in said]
    rows = F.inline(F.array(*[F.struct(F.lit(o).alias("offer"), F.lit(r).alias("refused")) for o, r in refused]))
    return offered.select("offered", rows)


@_add("S4_type_freeze", """
    SELECT count(*) AS offered, TRUE AS clean_loads, TRUE AS wrong_type_refused, TRUE AS extra_cell_refused FROM lineitem""")
def _(spark, sf_dir, folder):
    items = raw_tables(spark, sf_dir)["order_items"]
    spoiled = items.withColumn(
        "price", F.when(F.col("order_item_id") % 97 == 0, "fifty-eight").otherwise(F.col("price").cast("string"))
    )
    # A comma inside an unquoted last value is one more cell.
    widened = items.withColumn("freight_value", F.concat(F.col("freight_value").cast("string"), F.lit(",EXTRA")))
    _offer(items, f"{folder}/clean", "order_items")
    _offer(spoiled, f"{folder}/spoiled", "order_items")
    widened.write.options(header="true", quote="\u0000").csv(location(f"{folder}/wide", RAW_TABLES["order_items"]))

    def said(place: str) -> str:
        # Neither spoiled column is asked for.
        read = scan(spark, f"{folder}/{place}", RAW_TABLES["order_items"])
        return _refusal("order_items", lambda: read.agg(F.max("order_id")).collect())

    refused = lambda place: F.lit("alformed" in said(place) or "MALFORMED" in said(place))
    return scan(spark, f"{folder}/clean", RAW_TABLES["order_items"]).agg(F.count("*").alias("offered")).select(
        "offered", F.lit(said("clean") == "none").alias("clean_loads"),
        refused("spoiled").alias("wrong_type_refused"), refused("wide").alias("extra_cell_refused"),
    )


@_add("S4b_refusal_report", """
    SELECT 'order_items' AS table, 'type' AS problem, 'price' AS "column", 'fifty-eight' AS value, count(*) AS n FROM stg_order_items WHERE order_item_id % 3 = 0
    UNION ALL SELECT 'order_items', 'type', 'order_item_id', 'one', count(*) FROM stg_order_items WHERE order_item_id % 2 = 0
    UNION ALL SELECT 'sellers', 'header: undeclared columns', 'loyalty_tier', NULL, 1""")
def _(spark, sf_dir, folder):
    """Every refused cell and part of a snapshot, counted; clean parts and rows give none."""
    tables = raw_tables(spark, sf_dir)
    items, sellers = tables["order_items"], tables["sellers"]
    line = F.col("order_item_id")
    spoiled = items.withColumns({
        "price": F.when(line % 3 == 0, "fifty-eight").otherwise(F.col("price").cast("string")),
        "order_item_id": F.when(line % 2 == 0, "one").otherwise(line.cast("string")),
    })
    _offer(spoiled, folder, "order_items")
    _offer(sellers, folder, "sellers")
    _append(sellers.limit(3).withColumn("loyalty_tier", F.lit("gold")), folder, "sellers")
    found = findings(spark, folder, {name: RAW_TABLES[name] for name in ("order_items", "sellers")})
    return _count_by(found, "table", "problem", "column", "value")


@_add("S5_all_null_column", "SELECT 'timestamp' AS type, count(*) AS n, count(*) AS empty FROM orders")
def _(spark, sf_dir, folder):
    delivered = "order_delivered_customer_date"
    emptied = raw_tables(spark, sf_dir)["orders"].withColumn(delivered, F.lit(None).cast("timestamp"))
    _offer(emptied, folder, "orders")
    scanned = scan(spark, folder, RAW_TABLES["orders"])
    return scanned.groupBy(F.typeof(delivered).alias("type")).agg(
        F.count("*").alias("n"), F.count_if(F.col(delivered).isNull()).alias("empty")
    )


@_add("S6_blank_timestamp_is_null", """
    SELECT order_status AS status, count(*) AS n, count(order_approved_at) AS approved,
           count(order_delivered_customer_date) AS delivered, max(order_delivered_customer_date) AS last_delivered
    FROM raw_orders GROUP BY 1""")
def _(spark, sf_dir, folder):
    scanned = _rescanned(spark, sf_dir, folder, "orders")
    return scanned.groupBy(F.col("order_status").alias("status")).agg(
        F.count("*").alias("n"), F.count("order_approved_at").alias("approved"),
        F.count("order_delivered_customer_date").alias("delivered"),
        F.max("order_delivered_customer_date").alias("last_delivered"),
    )


@_add("S7_leading_zeros", "SELECT customer_zip_code_prefix AS zip, count(*) AS n FROM raw_customers GROUP BY 1")
def _(spark, sf_dir, folder):
    return _count_by(
        _rescanned(spark, sf_dir, folder, "customers").withColumnRenamed("customer_zip_code_prefix", "zip"), "zip"
    )


@_add("S8_missing_files", """
    SELECT 'customers_dataset.csv' AS file, count(*) AS rows FROM orders
    UNION ALL SELECT 'orders_dataset.csv', count(*) FROM orders
    UNION ALL SELECT unnest(['order_items_dataset.csv', 'order_payments_dataset.csv', 'order_reviews_dataset.csv',
                             'products_dataset.csv', 'sellers_dataset.csv', 'geolocation_dataset.csv',
                             'product_category_name_translation.csv']), NULL""")
def _(spark, sf_dir, folder):
    raw = raw_tables(spark, sf_dir)
    for table in _PAIR:
        _offer(raw[table], folder, table)
    absent = missing_files(spark, folder)
    result = spark.createDataFrame([(f, None) for f in absent], "file string, rows bigint")
    for table in _PAIR.values():
        rows = scan(spark, folder, table).agg(F.count("*").alias("rows"))
        result = result.unionAll(rows.select(F.lit(table.file).alias("file"), "rows"))
    return result


def _landed(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Lands all orders on two days, the second twice, then only early orders."""
    raw, zone = raw_tables(spark, sf_dir), f"{folder}/zone"
    for table in _PAIR:
        _offer(raw[table], f"{folder}/incoming", table)
    for day, hour in ((date(2024, 1, 1), 8), (date(2024, 1, 2), 9), (date(2024, 1, 2), 10)):
        landing.land(spark, f"{folder}/incoming", zone, day, _STAMP.replace(hour=hour), _PAIR)
    early = raw["orders"].where(F.year("order_purchase_timestamp") < 1998)
    _offer(early, f"{folder}/later", "orders")
    _offer(raw["customers"], f"{folder}/later", "customers")
    landing.land(spark, f"{folder}/later", zone, date(2024, 1, 3), _STAMP, _PAIR)
    return zone


@_add("S9_dated_snapshots", """
    SELECT unnest(['2024-01-01', '2024-01-02']) AS day, (SELECT count(*) FROM orders) AS orders
    UNION ALL SELECT '2024-01-03', count(*) FROM orders WHERE year(o_orderdate) < 1998""")
def _(spark, sf_dir, folder):
    zone = _landed(spark, sf_dir, folder)
    result = None
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)):
        rows = scan(spark, landing.prefix_on(spark, zone, day), RAW_TABLES["orders"]).agg(F.count("*").alias("orders"))
        row = rows.select(F.lit(day.isoformat()).alias("day"), "orders")
        result = row if result is None else result.unionAll(row)
    return result


@_add("S10_replay_latest_or_chosen", """
    SELECT 'latest' AS which, count(*) AS orders FROM orders WHERE year(o_orderdate) < 1998
    UNION ALL SELECT 'chosen', count(*) FROM orders""")
def _(spark, sf_dir, folder):
    zone = _landed(spark, sf_dir, folder)
    prefixes = {"latest": landing.latest_prefix(spark, zone), "chosen": landing.prefix_on(spark, zone, date(2024, 1, 1))}
    parts = [
        scan(spark, prefix, RAW_TABLES["orders"]).agg(F.count("*").alias("orders")).select(F.lit(k).alias("which"), "orders")
        for k, prefix in prefixes.items()
    ]
    return parts[0].unionAll(parts[1])


def _loaded_twice(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, DataFrame]:
    raw = raw_tables(spark, sf_dir)
    for table in _PAIR:
        _offer(raw[table], f"{folder}/incoming", table)
    # A file nobody declared lies beside them and is not loaded.
    _count_by(raw["orders"], "order_status").write.mode("overwrite").option("header", True).csv(
        f"{folder}/incoming/unrelated.csv"
    )
    for load_id in ("first", "second"):
        loaded = landing.load(spark, f"{folder}/incoming", f"{folder}/raw", load_id, _STAMP, _PAIR)
    return loaded


@_add("S11_replace_load", """
    SELECT customer_state, count(*) AS n, count(DISTINCT customer_id) AS ids FROM raw_customers GROUP BY 1""")
def _(spark, sf_dir, folder):
    return _loaded_twice(spark, sf_dir, folder)["customers"].groupBy("customer_state").agg(
        F.count("*").alias("n"), F.countDistinct("customer_id").alias("ids")
    )


@_add("S11b_refused_load_keeps_the_last", """
    SELECT 'order_items_dataset.csv' AS refused_file, 'first' AS load_id, count(*) AS n FROM lineitem""")
def _(spark, sf_dir, folder):
    items = raw_tables(spark, sf_dir)["order_items"]
    only = {"order_items": RAW_TABLES["order_items"]}
    _offer(items, f"{folder}/good", "order_items")
    _offer(items.withColumn("price", F.lit("fifty-eight")), f"{folder}/bad", "order_items")
    landing.load(spark, f"{folder}/good", f"{folder}/raw", "first", _STAMP, only)
    said = _refusal("order_items", lambda: landing.load(spark, f"{folder}/bad", f"{folder}/raw", "second", _STAMP, only))
    kept = _count_by(landing.read_raw(spark, f"{folder}/raw", only)["order_items"], "load_id")
    return kept.select(F.lit(said.split(":")[0]).alias("refused_file"), "load_id", "n")


@_add("S12_load_id", "SELECT 'second' AS load_id, TRUE AS logged, count(*) AS n FROM orders")
def _(spark, sf_dir, folder):
    orders = _loaded_twice(spark, sf_dir, folder)["orders"]
    log = landing.loads(spark, f"{folder}/raw").groupBy("load_id").agg(F.max(F.lit(True)).alias("logged"))
    return _count_by(orders, "load_id").join(log, "load_id").select("load_id", "logged", "n")


@_add("S13_declared_tables_only", "SELECT unnest(['customers', 'orders']) AS loaded, (SELECT count(*) FROM orders) AS n")
def _(spark, sf_dir, folder):
    loaded = _loaded_twice(spark, sf_dir, folder)
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("loaded"), "n") for name, df in loaded.items()]
    return parts[0].unionAll(parts[1])


@_add("S14_scan_by_name", "SELECT order_status, count(*) AS n FROM stg_orders GROUP BY 1")
def _(spark, sf_dir, folder):
    models(spark, sf_dir).stg_orders.createOrReplaceTempView("catalog_stg_orders")
    return _count_by(spark.table("catalog_stg_orders"), "order_status")


@_add("S15_view", "SELECT seller_state, count(*) AS n FROM dim_seller GROUP BY 1")
def _(spark, sf_dir, folder):
    models(spark, sf_dir).dim_seller.createOrReplaceTempView("catalog_dim_seller")
    return spark.sql("SELECT seller_state, count(*) AS n FROM catalog_dim_seller GROUP BY seller_state")


@_add("S16_table", "SELECT product_category_name, count(*) AS n FROM dim_product GROUP BY 1")
def _(spark, sf_dir, folder):
    for _ in range(2):
        stored = write_table(models(spark, sf_dir).dim_product, folder)
    return _count_by(stored, "product_category_name")


@_add("S16b_failed_write_keeps_the_last", """
    SELECT product_category_name, count(*) AS n, TRUE AS refused FROM dim_product GROUP BY 1""")
def _(spark, sf_dir, folder):
    products = models(spark, sf_dir).dim_product
    write_table(products, folder)
    try:
        write_table(products.where(F.raise_error(F.lit("lost")).isNull()), folder)
        refused = False
    except PySparkException:
        refused = True
    return _count_by(versions.read(spark, folder), "product_category_name").withColumn("refused", F.lit(refused))


@_add("S17_day_partitioned_table", """
    SELECT review_creation_date, count(*) AS n, sum(review_score)::BIGINT AS score FROM fct_reviews
    WHERE review_creation_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1""")
def _(spark, sf_dir, folder):
    reviews = models(spark, sf_dir).fct_reviews
    stored = write_partitioned(reviews, folder, "review_creation_date", ["order_id"])
    window = stored.where(
        F.col("review_creation_date").between(F.lit(date(2024, 1, 5)), F.lit(date(2024, 1, 20)))
    )
    return window.groupBy("review_creation_date").agg(
        F.count("*").alias("n"), F.sum("review_score").alias("score")
    )


@_add("S17b_replace_days", """
    SELECT year(review_creation_date)::INTEGER AS year, count(*) AS n, sum(review_score)::BIGINT AS score FROM (
      SELECT review_creation_date, CASE WHEN day(review_creation_date) = 3 THEN 5 ELSE review_score END AS review_score FROM fct_reviews)
    GROUP BY 1""")
def _(spark, sf_dir, folder):
    reviews = models(spark, sf_dir).fct_reviews
    layout = ("review_creation_date", ["order_id"])
    write_partitioned(reviews, folder, *layout)
    third = reviews.where(F.dayofmonth("review_creation_date") == 3).withColumn(
        "review_score", F.lit(5).cast("bigint")
    )
    stored = replace_days(third, folder, *layout)
    return stored.groupBy(F.year("review_creation_date").alias("year")).agg(
        F.count("*").alias("n"), F.sum("review_score").alias("score")
    )


@_add("S17c_only_changed_days", """
    SELECT review_creation_date AS day, TRUE AS rewritten, count(*) AS n, max(review_score)::BIGINT AS best FROM fct_reviews
    WHERE day(review_creation_date) = 3 AND review_score = 5 GROUP BY 1""")
def _(spark, sf_dir, folder):
    """One row less on some days: these days alone are written again."""
    reviews = models(spark, sf_dir).fct_reviews
    layout = ("review_creation_date", ["order_id"])
    refresh_days(reviews, folder, *layout)
    third = F.coalesce(F.dayofmonth("review_creation_date") == 3, F.lit(False))
    written = refresh_days(reviews.where(~third | (F.col("review_score") == 5)), folder, *layout)
    stored = versions.read(spark, folder, reviews.schema, "review_creation_date")
    days = stored.groupBy(F.col("review_creation_date").alias("day")).agg(F.count("*").alias("n"), F.max("review_score").alias("best"))
    return days.where(versions.is_one_of(F.col("day"), set(written))).select("day", F.lit(True).alias("rewritten"), "n", "best")


@_add("S18_clustered_table", """
    SELECT payment_type, count(*) AS n, sum(payment_value)::DOUBLE AS value FROM fct_payments
    WHERE order_id BETWEEN 'o2' AND 'o3' GROUP BY 1""")
def _(spark, sf_dir, folder):
    stored = write_clustered(models(spark, sf_dir).fct_payments, folder, ["order_id", "payment_sequential"])
    return stored.where(F.col("order_id").between("o2", "o3")).groupBy("payment_type").agg(
        F.count("*").alias("n"), F.sum("payment_value").alias("value")
    )


@_add("S18b_ordered_by_two_keys", """
    SELECT 'product' AS asked, product_key AS "key", count(*) AS n, sum(price)::DOUBLE AS price FROM fct_order_items
    WHERE product_key BETWEEN 'p10' AND 'p12' GROUP BY 2
    UNION ALL SELECT 'seller', seller_key, count(*), sum(price)::DOUBLE FROM fct_order_items
    WHERE seller_key BETWEEN 's1' AND 's3' GROUP BY 2""")
def _(spark, sf_dir, folder):
    """Lookups by product or by seller both skip most of one table."""
    stored = write_zordered(models(spark, sf_dir).fct_order_items, folder, ["product_key", "seller_key"], ["order_id", "order_item_id"])

    def asked(name: str, first: str, last: str) -> DataFrame:
        key = F.col(f"{name}_key")
        found = stored.where(key.between(first, last)).groupBy(key.alias("key"))
        return found.agg(F.count("*").alias("n"), F.sum("price").alias("price")).select(F.lit(name).alias("asked"), "*")

    return asked("product", "p10", "p12").unionByName(asked("seller", "s1", "s3"))


@_add("S19_target_switch", """
    SELECT 'ci' AS target, count(*) AS n FROM supplier WHERE s_nationkey < 10 UNION ALL SELECT 'dev', count(*) FROM supplier""")
def _(spark, sf_dir, folder):
    suppliers = read(spark, sf_dir, "supplier")
    parts = []
    for target, rows in {"dev": suppliers, "ci": suppliers.where(F.col("s_nationkey") < 10)}.items():
        stored = write_table(rows, Lake(folder, target).path("raw", "sellers"))
        parts.append(stored.agg(F.count("*").alias("n")).select(F.lit(target).alias("target"), "n"))
    return parts[0].unionAll(parts[1])


@_add("S20_scan_without_inference", """
    SELECT payment_type, count(*) AS n, min(payment_installments) AS fewest, max(payment_installments) AS most
    FROM raw_order_payments GROUP BY 1""")
def _(spark, sf_dir, folder):
    # Padding around a value survives the file.
    payments = _rescanned(spark, sf_dir, folder, "order_payments")
    return payments.groupBy("payment_type").agg(
        F.count("*").alias("n"), F.min("payment_installments").alias("fewest"),
        F.max("payment_installments").alias("most"),
    )


@_add("S21_guarded_overwrite", """
    SELECT year(order_purchase_timestamp)::INTEGER AS year, count(*) AS n, FALSE AS replaced_unasked
    FROM raw_orders o JOIN raw_order_items i ON o.order_id = i.order_id
    WHERE order_delivered_customer_date <= order_estimated_delivery_date GROUP BY 1""")
def _(spark, sf_dir, folder):
    sales = analytics.sla_sales(models(spark, sf_dir))
    publish(sales, folder, allow_replace=True)
    unasked = publish(sales.limit(0), folder)
    return _count_by(versions.read(spark, folder), "year").withColumn("replaced_unasked", F.lit(unasked))


@_add("S22_small_client_frame", "SELECT order_status, count(*) AS n FROM stg_orders GROUP BY 1")
def _(spark, sf_dir, folder):
    frame = to_client(_count_by(models(spark, sf_dir).stg_orders, "order_status"), max_rows=100)
    return spark.createDataFrame(frame)


@_add("S23_date_spine", "SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM day_bounds")
def _(spark, sf_dir, folder):
    return spine_covering(read(spark, sf_dir, "orders"), "o_orderdate")


@_add("S24_json_records", """
    SELECT customer_state AS name, count(*) AS customers, sum(lifetime_revenue)::DOUBLE AS revenue FROM dim_customer GROUP BY 1""")
def _(spark, sf_dir, folder):
    states = models(spark, sf_dir).dim_customer.groupBy(F.col("customer_state").alias("name")).agg(
        F.count("*").alias("customers"), F.sum("lifetime_revenue").alias("revenue")
    )
    write_json_records(states, folder)
    return spark.read.schema("name string, customers bigint, revenue double").json(folder)
