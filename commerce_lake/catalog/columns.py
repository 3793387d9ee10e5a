"""P1-P28 and F1-F17: single projections, filters and functions on test tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from commerce_lake.bindings import state_regions
from commerce_lake.catalog.common import Registry
from commerce_lake.catalog.views import stripped
from commerce_lake.functions import dates, labels, numbers, text
from commerce_lake.operators.percentiles import exact_percentiles
from commerce_lake.operators.ranking import first_per_group
from commerce_lake.operators.shares import running_share, share_of_groups

registry = Registry()
add = registry.add
_MONEY = "DECIMAL(18,2)"


def _count_by(df, *columns):
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


# Cleaning ---------------------------------------------------------------


@add("P1_trim_codes", "orders",
     f"SELECT {stripped("chr(9) || ' ' || o_orderpriority || chr(13) || chr(10)")} AS code, count(*) AS n FROM orders GROUP BY 1")
def _(orders):
    padded = orders.select(F.concat(F.lit("\t "), "o_orderpriority", F.lit("\r\n")).alias("code"))
    return _count_by(padded.select(text.trimmed("code")), "code")


@add("P2_lower_text", "customer",
     f"SELECT lower({stripped("c_mktsegment || chr(9) || chr(160)")}) AS c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(customer):
    dirty = customer.withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit("\t\u00a0")))
    return _count_by(dirty.select(text.lower_text("c_mktsegment")), "c_mktsegment")


@add("P3_upper_code", "part", f"SELECT upper({stripped("chr(10) || p_brand")}) AS p_brand, count(*) AS n FROM part GROUP BY 1")
def _(part):
    dirty = part.withColumn("p_brand", F.concat(F.lit("\n"), "p_brand"))
    return _count_by(dirty.select(text.upper_code("p_brand")), "p_brand")


@add("P4_blank_to_null", "part",
     f"SELECT nullif({stripped("CASE WHEN p_size < 5 THEN chr(10) || chr(9) ELSE p_type END")}, '') AS kind, count(*) AS n FROM part GROUP BY 1")
def _(part):
    dirty = F.when(F.col("p_size") < 5, "\n\t").otherwise(F.col("p_type"))
    return _count_by(part.select(text.blank_to_null(dirty).alias("kind")), "kind")


@add("P5_cast_whole", "lineitem",
     "SELECT l_returnflag, sum(l_quantity::BIGINT)::BIGINT AS quantity FROM lineitem GROUP BY 1")
def _(lineitem):
    lines = lineitem.select("l_returnflag", numbers.whole("l_quantity"))
    return lines.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity"))


@add("P6_cast_money", "lineitem",
     f"SELECT l_returnflag, sum(l_extendedprice::{_MONEY})::DOUBLE AS price FROM lineitem GROUP BY 1")
def _(lineitem):
    lines = lineitem.select("l_returnflag", numbers.money("l_extendedprice"))
    return lines.groupBy("l_returnflag").agg(F.sum("l_extendedprice").alias("price"))


@add("P7_cast_timestamp", "orders",
     "SELECT o_orderstatus, min(o_orderdate)::TIMESTAMP AS first_at, max(o_orderdate)::TIMESTAMP AS last_at FROM orders GROUP BY 1")
def _(orders):
    as_text = orders.select("o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return as_text.select("o_orderstatus", dates.timestamp("at")).groupBy("o_orderstatus").agg(
        F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )


@add("P8_tolerant_timestamp", "orders",
     """SELECT o_orderstatus, count(*) FILTER (o_orderkey % 10 = 0) AS unreadable,
               max(o_orderdate::TIMESTAMP) FILTER (o_orderkey % 10 <> 0) AS last_at FROM orders GROUP BY 1""")
def _(orders):
    raw = F.when(F.col("o_orderkey") % 10 == 0, "not a date").otherwise(F.col("o_orderdate").cast("string"))
    parsed = orders.select("o_orderstatus", dates.tolerant_timestamp(raw).alias("at"))
    return parsed.groupBy("o_orderstatus").agg(
        F.count_if(F.col("at").isNull()).alias("unreadable"), F.max("at").alias("last_at")
    )


@add("P9_cast_quantile_input", "lineitem",
     "SELECT l_returnflag, quantile_cont(l_linenumber::DOUBLE, 0.5) AS p0, quantile_cont(l_linenumber::DOUBLE, 0.9) AS p1 FROM lineitem GROUP BY 1")
def _(lineitem):
    lines = lineitem.select("l_returnflag", numbers.double("l_linenumber").alias("number"))
    return exact_percentiles(lines, ["l_returnflag"], "number", [0.5, 0.9], 2.0)


@add("P10_rename_columns", "part", "SELECT p_partkey AS product_key, p_type AS category, p_size AS size_cm FROM part")
def _(part):
    renamed = part.withColumnsRenamed({"p_partkey": "product_key", "p_type": "category", "p_size": "size_cm"})
    return renamed.select("product_key", "category", "size_cm")


@add("P11_drop_helper_column", "orders",
     """SELECT * EXCLUDE (r) FROM (SELECT o_custkey, o_orderkey, o_orderdate,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def _(orders):
    kept = orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return first_per_group(kept, ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")])


@add("P12_subset_before_join", "lineitem orders",
     f"""SELECT o_orderpriority, sum(l_extendedprice::{_MONEY})::DOUBLE AS price
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(lineitem, orders):
    lines = lineitem.select("l_orderkey", numbers.money("l_extendedprice"))
    per_order = lines.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("price"))
    needed = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return per_order.join(needed, "l_orderkey").groupBy("o_orderpriority").agg(F.sum("price").alias("price"))


@add("P13_null_to_zero", "orders lineitem",
     f"""SELECT o_orderstatus, sum(coalesce(p, 0))::DOUBLE AS price, sum(coalesce(n, 0))::BIGINT AS lines
         FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice::{_MONEY}) AS p, count(*) AS n FROM lineitem GROUP BY 1)
           ON l_orderkey = o_orderkey GROUP BY 1""")
def _(orders, lineitem):
    totals = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), numbers.money("l_extendedprice"))
    totals = totals.groupBy("o_orderkey").agg(F.sum("l_extendedprice").alias("price"), F.count("*").alias("lines"))
    return orders.join(totals, "o_orderkey", "left").groupBy("o_orderstatus").agg(
        F.sum(numbers.zero_money("price")).alias("price"), F.sum(numbers.zero_count("lines")).alias("lines")
    )


@add("P14_unknown_member", "part",
     "SELECT coalesce(CASE WHEN p_size >= 5 THEN p_type END, 'unknown') AS kind, count(*) AS n FROM part GROUP BY 1")
def _(part):
    return _count_by(
        part.select(text.or_unknown(F.when(F.col("p_size") >= 5, F.col("p_type"))).alias("kind")), "kind"
    )


@add("P15_money_arithmetic", "lineitem",
     f"""SELECT l_linestatus, sum(l_extendedprice::{_MONEY} + l_tax::{_MONEY})::DOUBLE AS gross FROM lineitem GROUP BY 1""")
def _(lineitem):
    lines = lineitem.select("l_linestatus", numbers.money("l_extendedprice"), numbers.money("l_tax"))
    return lines.groupBy("l_linestatus").agg(F.sum(F.col("l_extendedprice") + F.col("l_tax")).alias("gross"))


@add("P16_tolerance_flag", "lineitem",
     f"""SELECT abs(l_discount::{_MONEY} - l_tax::{_MONEY}) <= 0.01 AS close, count(*) AS n,
                sum(l_discount::{_MONEY} - l_tax::{_MONEY})::DOUBLE AS difference FROM lineitem GROUP BY 1""")
def _(lineitem):
    difference = F.col("l_discount") - F.col("l_tax")
    lines = lineitem.select(numbers.money("l_discount"), numbers.money("l_tax"))
    flagged = lines.select((F.abs(difference) <= F.lit(Decimal("0.01"))).alias("close"), difference.alias("d"))
    return flagged.groupBy("close").agg(F.count("*").alias("n"), F.sum("d").alias("difference"))


# Predicates ---------------------------------------------------------------


@add("P17_three_valued_late_flag", "orders",
     """SELECT CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE o_orderdate::TIMESTAMP + to_days((o_orderkey % 40)::INTEGER) > o_orderdate + INTERVAL 25 DAY END AS is_late,
               count(*) AS n FROM orders GROUP BY 1""")
def _(orders):
    spans = orders.select(
        F.expr("if(o_orderstatus = 'P', null, o_orderdate + make_dt_interval(cast(o_orderkey % 40 as int)))").alias("done"),
        F.expr("o_orderdate + make_dt_interval(25)").alias("due"),
    )
    return _count_by(spans.select(dates.is_after_deadline("done", "due").alias("is_late")), "is_late")


@add("P18_membership_parameter", "orders",
     "SELECT o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, count(*) AS n FROM orders GROUP BY 1")
def _(orders):
    urgent = ("1-URGENT", "2-HIGH")
    return _count_by(orders.select(F.col("o_orderpriority").isin(*urgent).alias("urgent")), "urgent")


@add("P19_membership_literal", "part",
     "SELECT p_type, count(*) AS n FROM part WHERE p_type IN ('SMALL', 'LARGE') GROUP BY 1")
def _(part):
    return _count_by(part.where(F.col("p_type").isin("SMALL", "LARGE")), "p_type")


@add("P20_range_filter", "customer",
     "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal BETWEEN 0 AND 5000 GROUP BY 1")
def _(customer):
    return _count_by(customer.where(F.col("c_acctbal").between(0, 5000)), "c_mktsegment")


@add("P21_null_filter", "orders lineitem",
     """SELECT o_orderstatus, count(*) AS n FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey
        WHERE l_orderkey IS NULL GROUP BY 1""")
def _(orders, lineitem):
    sold = lineitem.select("l_orderkey").distinct()
    joined = orders.join(sold, orders.o_orderkey == sold.l_orderkey, "left")
    return _count_by(joined.where(F.col("l_orderkey").isNull()), "o_orderstatus")


@add("P22_equality_and_flag_filter", "orders",
     "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000 GROUP BY 1")
def _(orders):
    flagged = orders.withColumn("is_large", F.col("o_totalprice") > 100000)
    return _count_by(flagged.where((F.col("o_orderstatus") == "F") & F.col("is_large")), "o_orderpriority")


@add("P23_date_cutoff", "orders",
     """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
        WHERE o_orderdate <= DATE '1998-06-30' AND strftime(o_orderdate, '%Y-%m') >= '1996-10' GROUP BY 1""")
def _(orders):
    months = orders.where(F.to_date("o_orderdate") <= F.lit(date(1998, 6, 30))).select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    return _count_by(months.where(F.col("month") >= "1996-10"), "month")


@add("P24_has_text", "events",
     """SELECT (CASE WHEN event_id % 3 <> 0 THEN event_type END) IS NOT NULL OR (CASE WHEN event_id % 4 <> 0 THEN props END) IS NOT NULL AS has_text,
               count(*) AS n FROM events GROUP BY 1""")
def _(events):
    title = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    message = F.when(F.col("event_id") % 4 != 0, F.col("props"))
    return _count_by(events.select((title.isNotNull() | message.isNotNull()).alias("has_text")), "has_text")


@add("P25_ordinal_bucket", "lineitem orders",
     """SELECT CASE WHEN d <= 0 THEN '0  on time / early' WHEN d <= 3 THEN '1  1-3 days late' WHEN d <= 7 THEN '2  4-7 days late'
                    WHEN d <= 15 THEN '3  8-15 days late' ELSE '4  16+ days late' END AS bucket, count(*) AS n
        FROM (SELECT date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""")
def _(lineitem, orders):
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    days = dates.day_gap("o_orderdate", "l_shipdate")
    return _count_by(joined.select(labels.lateness(days > 0, days).alias("bucket")), "bucket")


@add("P26_segment_bucket", "orders",
     """SELECT segment, count(*) AS customers FROM (
          SELECT CASE WHEN count(*) = 1 THEN '1 order' WHEN count(*) < 4 THEN count(*) || ' orders' ELSE '4+ orders' END AS segment
          FROM orders GROUP BY o_custkey) GROUP BY 1""")
def _(orders):
    placed = orders.groupBy("o_custkey").agg(F.count("*").alias("placed"))
    segments = placed.groupBy(labels.order_segment(F.col("placed")).alias("segment"))
    return segments.agg(F.count("*").alias("customers"))


@add("P26b_recency_bucket", "orders",
     """SELECT CASE WHEN d <= 180 THEN '0-180 days' WHEN d <= 365 THEN '181-365 days' WHEN d <= 540 THEN '366-540 days' ELSE '540+ days' END AS bucket,
               count(*) AS n FROM (SELECT date_diff('day', o_orderdate::DATE, DATE '2001-12-31') AS d FROM orders) GROUP BY 1""")
def _(orders):
    age = F.datediff(F.lit(date(2001, 12, 31)), F.to_date("o_orderdate"))
    return _count_by(orders.select(labels.recency(age).alias("bucket")), "bucket")


@add("P27_deadline_filter", "orders lineitem",
     """SELECT o_orderpriority, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END <= o_orderdate GROUP BY 1""")
def _(orders, lineitem):
    shipped = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("shipped"),
    )
    in_time = orders.join(shipped, "o_orderkey").where(F.col("shipped") <= F.col("o_orderdate"))
    return _count_by(in_time, "o_orderpriority")


@add("P28_static_lookup", "customer nation region",
     """SELECT r_name AS region, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def _(customer, nation, region):
    located = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    named = located.join(nation, "n_nationkey").withColumnRenamed("n_name", "state")
    return named.join(state_regions(nation, region), "state").groupBy("region").agg(F.sum("n").alias("n"))


# Functions ----------------------------------------------------------------


@add("F1_text_functions", "part",
     """SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, nullif(p_brand, 'Brand#1') AS brand,
               coalesce(nullif(p_brand, 'Brand#1'), 'unknown') AS known FROM part""")
def _(part):
    brand = F.nullif("p_brand", F.lit("Brand#1"))
    return part.select(
        "p_partkey", F.lower("p_type").alias("low"), F.upper("p_name").alias("up"),
        brand.alias("brand"), text.or_unknown(brand).alias("known"),
    )


@add("F2_concat", "supplier", "SELECT s_name || ' / ' || s_nationkey AS place, s_name || '/' || s_nationkey AS short FROM supplier")
def _(supplier):
    return supplier.select(
        text.place_label("s_name", "s_nationkey").alias("place"),
        text.place_label("s_name", "s_nationkey", "/").alias("short"),
    )


@add("F3_split_from_right", "orders",
     """SELECT tail, head, count(*) AS n FROM (
          SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'plain' ELSE o_orderstatus END AS tail,
                 CASE o_orderkey % 3 WHEN 0 THEN 'plain' WHEN 1 THEN o_orderpriority ELSE o_orderpriority || ' / mid' END AS head
          FROM orders) GROUP BY 1, 2""")
def _(orders):
    label = F.expr(
        """element_at(array('plain', concat(o_orderpriority, ' / ', o_orderstatus),
                            concat(o_orderpriority, ' / mid / ', o_orderstatus)), cast(o_orderkey % 3 as int) + 1)"""
    )
    split = orders.select(label.alias("label")).select(
        text.label_tail("label").alias("tail"), text.label_head("label").alias("head")
    )
    return _count_by(split, "tail", "head")


@add("F4_abs_and_round", "lineitem",
     f"""SELECT l_orderkey, l_linenumber, abs(l_discount::{_MONEY} - l_tax::{_MONEY})::DOUBLE AS gap,
                round(l_extendedprice::{_MONEY}, 0)::DOUBLE AS whole, round(l_extendedprice::{_MONEY}, 1)::DOUBLE AS tenth FROM lineitem""")
def _(lineitem):
    price = F.col("l_extendedprice").cast(numbers.MONEY)
    gap = F.col("l_discount").cast(numbers.MONEY) - F.col("l_tax").cast(numbers.MONEY)
    return lineitem.select(
        "l_orderkey", "l_linenumber", F.abs(gap).alias("gap"),
        F.round(price, 0).alias("whole"), F.round(price, 1).alias("tenth"),
    )


@add("F5_date_of_timestamp", "events", "SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1")
def _(events):
    return _count_by(events.select(F.to_date("ts").alias("day")), "day")


@add("F6_elapsed_days", "events",
     """SELECT event_id, date_sub('hour', ts::TIMESTAMP, TIMESTAMP '2024-01-15 12:00:00') / 24.0::DOUBLE AS days FROM events""")
def _(events):
    spans = events.withColumn("until", F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return spans.select("event_id", dates.elapsed_days("ts", "until").alias("days"))


@add("F7_day_gap", "lineitem orders",
     """SELECT date_diff('day', o_orderdate::DATE, l_shipdate::DATE) // 100 AS hundreds, count(*) AS n
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate GROUP BY 1""")
def _(lineitem, orders):
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    gaps = joined.where(F.col("l_shipdate") >= F.col("o_orderdate")).select(
        F.floor(dates.day_gap("o_orderdate", "l_shipdate") / 100).alias("hundreds")
    )
    return _count_by(gaps, "hundreds")


@add("F8_add_month", "orders", "SELECT DISTINCT o_orderdate::DATE AS day, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE AS next_month FROM orders")
def _(orders):
    days = orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", F.add_months("day", 1).alias("next_month"))


@add("F9_last_day", "orders", "SELECT last_day(o_orderdate::DATE) AS month_end, count(*) AS n FROM orders GROUP BY 1")
def _(orders):
    return _count_by(orders.select(F.last_day(F.to_date("o_orderdate")).alias("month_end")), "month_end")


@add("F10_extract_parts", "orders",
     """SELECT DISTINCT o_orderdate::DATE AS day, year(o_orderdate)::INTEGER AS y, quarter(o_orderdate)::INTEGER AS q, month(o_orderdate)::INTEGER AS m,
               weekofyear(o_orderdate)::INTEGER AS w, (dayofweek(o_orderdate) + 1)::INTEGER AS d FROM orders""")
def _(orders):
    day = F.col("day")
    return orders.select(F.to_date("o_orderdate").alias("day")).distinct().select(
        "day", F.year(day).alias("y"), F.quarter(day).alias("q"), F.month(day).alias("m"),
        F.weekofyear(day).alias("w"), F.dayofweek(day).alias("d"),
    )


@add("F11_format_date", "orders",
     """SELECT year(o_orderdate) || '-Q' || quarter(o_orderdate) AS year_quarter, strftime(o_orderdate, '%B') AS month_name,
               strftime(o_orderdate, '%Y-%m') AS year_month, strftime(o_orderdate, '%A') AS day_name, count(*) AS n
        FROM orders GROUP BY 1, 2, 3, 4""")
def _(orders):
    days = orders.select(F.to_date("o_orderdate").alias("day"))
    named = days.select(*dates.calendar("day", date(2001, 7, 1)))
    return _count_by(named, "year_quarter", "month_name", "year_month", "day_name")


@add("F12_if_and_case", "lineitem",
     """SELECT CASE WHEN l_quantity > 25 THEN 'big' ELSE 'small' END AS size,
               CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'none' END AS flag, count(*) AS n
        FROM lineitem GROUP BY 1, 2""")
def _(lineitem):
    size = F.when(F.col("l_quantity") > 25, "big").otherwise("small")
    flag = F.when(F.col("l_returnflag") == "A", "accepted").when(F.col("l_returnflag") == "R", "returned").otherwise("none")
    return _count_by(lineitem.select(size.alias("size"), flag.alias("flag")), "size", "flag")


@add("F13_array_positions", "part",
     "SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, nullif(split_part(p_name, ' ', 5), '') AS fifth_word FROM part")
def _(part):
    words = F.split("p_name", " ")
    return part.select(
        "p_partkey", F.element_at(words, 1).alias("first_word"), F.get(words, F.lit(4)).alias("fifth_word")
    )


@add("F14_parse_and_parts", "orders",
     "SELECT month(o_orderdate)::INTEGER AS month, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY 1, 2")
def _(orders):
    parsed = orders.select(F.to_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("at"))
    return _count_by(parsed.select(F.month("at").alias("month"), F.year("at").alias("year")), "month", "year")


@add("F15_timestamp_difference", "lineitem orders",
     """SELECT l_orderkey, l_linenumber, date_sub('second', o_orderdate::TIMESTAMP, l_shipdate::TIMESTAMP) AS seconds
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(lineitem, orders):
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return joined.select(
        "l_orderkey", "l_linenumber", dates.elapsed_seconds("o_orderdate", "l_shipdate").alias("seconds")
    )


@add("F16_clip_and_histogram", "lineitem",
     """SELECT bin::BIGINT AS bin, count(*) AS n FROM (
          SELECT least(floor((least(l_quantity, 40.0::DOUBLE) - 1) * 13 / 39) + 1, 13) AS bin FROM lineitem) GROUP BY 1""")
def _(lineitem):
    clipped = F.least(F.col("l_quantity"), F.lit(40.0))
    return _count_by(
        lineitem.select(F.least(F.width_bucket(clipped, F.lit(1.0), F.lit(40.0), F.lit(13)), F.lit(13)).alias("bin")), "bin"
    )


@add("W7_running_share", "orders",
     """SELECT o_orderpriority, pct, round(sum(pct::DECIMAL(18,2)) OVER (ORDER BY n DESC, o_orderpriority), 1)::DOUBLE AS running FROM (
          SELECT o_orderpriority, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM orders GROUP BY 1)""")
def _(orders):
    shares = _count_by(orders, "o_orderpriority").withColumn("pct", share_of_groups("n", 2))
    running = running_share("pct", [F.desc("n"), F.col("o_orderpriority")])
    return shares.select("o_orderpriority", "pct", running.alias("running"))


QUERIES, ORACLES = registry.queries, registry.oracles
