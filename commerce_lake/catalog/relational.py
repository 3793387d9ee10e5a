"""J1-J20, G1-G24, W1-W8, O1-O6 and U1-U3 on the test tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.bindings import TEST_PARAMS
from commerce_lake.catalog.common import Registry
from commerce_lake.functions import numbers
from commerce_lake.functions.numbers import MONEY, mean, percent, percent_where
from commerce_lake.operators.bitmaps import daily_bitmaps, distinct_ids
from commerce_lake.operators.checks import orphans
from commerce_lake.operators.percentiles import exact_percentiles
from commerce_lake.operators.ranking import first_per_group, ranked
from commerce_lake.operators.shares import grand_total, in_one_row, share_of_groups
from commerce_lake.operators.sketches import digit_counts, merged, quantile_bounds
from commerce_lake.plans.marts import dim_date, spine_covering
from commerce_lake.sources.storage import shared_folder, write_table

registry = Registry()
add = registry.add
_M = "DECIMAL(18,2)"


def _count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def _price(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast(MONEY))


def _keyed(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def _line_totals(lineitem: DataFrame) -> DataFrame:
    return _price(lineitem, "l_extendedprice").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_extendedprice").alias("price"), F.count("*").alias("lines")
    )


_LINE_TOTALS = f"(SELECT l_orderkey, sum(l_extendedprice::{_M}) AS price, count(*) AS lines FROM lineitem GROUP BY 1)"

# Joins ------------------------------------------------------------------


@add("J1_inner_using", "customer orders",
     "SELECT c_mktsegment, o_orderstatus, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2")
def _(customer, orders):
    joined = orders.join(_keyed(customer, "c_custkey", "o_custkey"), "o_custkey")
    return _count_by(joined, "c_mktsegment", "o_orderstatus")


@add("J2_left_onto_spine", "customer orders events",
     f"""SELECT c_custkey, coalesce(o.n, 0) AS orders, coalesce(o.total, 0)::DOUBLE AS total, coalesce(e.n, 0) AS events FROM customer
         LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice::{_M}) AS total FROM orders GROUP BY 1) o ON o_custkey = c_custkey
         LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON user_id = c_custkey""")
def _(customer, orders, events):
    bought = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("total")
    )
    seen = events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("events"))
    spine = customer.select("c_custkey").join(bought, "c_custkey", "left").join(seen, "c_custkey", "left")
    return spine.select(
        "c_custkey", numbers.zero_count("orders").alias("orders"),
        numbers.zero_money("total").alias("total"), numbers.zero_count("events").alias("events"),
    )


@add("J3_left_after_inner", "customer orders lineitem",
     f"""SELECT c_mktsegment, count(*) AS orders, sum(coalesce(price, 0))::DOUBLE AS price FROM customer
         JOIN orders ON o_custkey = c_custkey LEFT JOIN {_LINE_TOTALS} ON l_orderkey = o_orderkey GROUP BY 1""")
def _(customer, orders, lineitem):
    joined = orders.join(_keyed(customer, "c_custkey", "o_custkey"), "o_custkey").join(
        _line_totals(lineitem), "o_orderkey", "left"
    )
    return joined.groupBy("c_mktsegment").agg(
        F.count("*").alias("orders"), F.sum(numbers.zero_money("price")).alias("price")
    )


@add("J4_left_enrichment", "supplier nation",
     "SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 20")
def _(supplier, nation):
    known = nation.where(F.col("n_nationkey") < 20).select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return supplier.join(known, "s_nationkey", "left").select("s_suppkey", "n_name")


@add("J5_left_lookup_null_key", "part",
     """SELECT p.kind, name, count(*) AS n FROM (SELECT CASE WHEN p_size >= 5 THEN p_type END AS kind FROM part) p
        LEFT JOIN (SELECT DISTINCT p_type AS kind, lower(p_type) AS name FROM part WHERE p_type <> 'PROMO') t ON p.kind = t.kind GROUP BY 1, 2""")
def _(part):
    # Parts are counted per kind first: a join on a key with six values would
    # otherwise send every part to one of six partitions.
    names = part.where(F.col("p_type") != "PROMO").select(F.col("p_type").alias("kind")).distinct()
    parts = _count_by(part.select(F.when(F.col("p_size") >= 5, F.col("p_type")).alias("kind")), "kind")
    return parts.join(names.withColumn("name", F.lower("kind")), "kind", "left").select("kind", "name", "n")


@add("J6_fact_to_fact", "lineitem orders",
     "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(lineitem, orders):
    header = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(header, "l_orderkey")


@add("J7_left_one_to_one", "orders lineitem",
     f"SELECT o_orderkey, o_orderstatus, price::DOUBLE AS price, lines FROM orders LEFT JOIN {_LINE_TOTALS} ON l_orderkey = o_orderkey")
def _(orders, lineitem):
    header = orders.select("o_orderkey", "o_orderstatus")
    return header.join(_line_totals(lineitem), "o_orderkey", "left")


@add("J8_lines_star", "lineitem orders part supplier nation",
     f"""SELECT p_type, n_name, count(*) AS lines, sum(l_extendedprice::{_M})::DOUBLE AS price FROM lineitem
         JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
         LEFT JOIN nation ON n_nationkey = s_nationkey WHERE o_orderstatus = 'F' GROUP BY 1, 2""")
def _(lineitem, orders, part, supplier, nation):
    finished = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    star = (
        _price(lineitem, "l_extendedprice")
        .join(finished, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    )
    return star.groupBy("p_type", "n_name").agg(
        F.count("*").alias("lines"), F.sum("l_extendedprice").alias("price")
    )


@add("J9_orders_star", "orders customer nation lineitem",
     f"""SELECT n_name, count(*) AS orders, sum(price)::DOUBLE AS price FROM orders JOIN customer ON c_custkey = o_custkey
         JOIN {_LINE_TOTALS} ON l_orderkey = o_orderkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def _(orders, customer, nation, lineitem):
    joined = (
        orders.join(_line_totals(lineitem), "o_orderkey")
        .join(_keyed(customer, "c_custkey", "o_custkey"), "o_custkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    return joined.groupBy("n_name").agg(F.count("*").alias("orders"), F.sum("price").alias("price"))


@add("J10_star_by_dimensions", "lineitem part supplier",
     f"""SELECT p_type, s_nationkey, sum(l_extendedprice::{_M})::DOUBLE AS price FROM lineitem
         JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2""")
def _(lineitem, part, supplier):
    # Lines are summed per dimension keys first; the joins see one row per pair.
    pairs = _price(lineitem, "l_extendedprice").groupBy(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")
    ).agg(F.sum("l_extendedprice").alias("price"))
    joined = pairs.join(part, "p_partkey").join(supplier, "s_suppkey")
    return joined.groupBy("p_type", "s_nationkey").agg(F.sum("price").alias("price"))


@add("J11_group_with_its_top_row", "customer",
     """SELECT c_nationkey, count(*) AS customers, any_value(best) AS best FROM customer
        JOIN (SELECT c_nationkey AS k, c_custkey AS best, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer)
          ON k = c_nationkey AND r = 1 GROUP BY 1""")
def _(customer):
    first = F.struct((-F.col("c_acctbal")).alias("a"), F.col("c_custkey").alias("b"))
    return customer.groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.min_by("c_custkey", first).alias("best")
    )


_BY_DATE = ("o_orderdate", "o_orderkey")


@add("J12_first_to_second", "orders",
     """WITH r AS (SELECT o_custkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
        SELECT a.o_custkey, date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE)::INTEGER AS gap
        FROM r a JOIN r b ON a.o_custkey = b.o_custkey WHERE a.n = 1 AND b.n = 2""")
def _(orders):
    first_two = ranked(orders, ["o_custkey"], [F.col(c) for c in _BY_DATE], 2, "n")
    pair = first_two.groupBy("o_custkey").agg(
        F.count("*").alias("found"), F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).alias("gap")
    )
    return pair.where(F.col("found") == 2).select("o_custkey", "gap")


@add("J13_fact_to_calendar", "orders",
     f"""SELECT strftime(o_orderdate, '%Y-%m') AS year_month, o_orderdate < DATE '2001-08-01' AS is_complete_month,
                sum(o_totalprice::{_M})::DOUBLE AS total FROM orders GROUP BY 1, 2""")
def _(orders):
    calendar = dim_date(spine_covering(orders, "o_orderdate"), TEST_PARAMS)
    days = orders.groupBy(F.to_date("o_orderdate").alias("date_key")).agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("total")
    )
    return days.join(calendar, "date_key").groupBy("year_month", "is_complete_month").agg(
        F.sum("total").alias("total")
    )


@add("J14_join_that_fans_out", "orders lineitem",
     "SELECT o_orderpriority, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def _(orders, lineitem):
    # The many side is summed per key; counts stay those of the joined rows.
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    return orders.join(per_order, "o_orderkey").groupBy("o_orderpriority").agg(
        F.sum("n").alias("n"), F.sum("quantity").alias("quantity")
    )


@add("J15_cohort_left_join", "orders customer",
     """SELECT c_mktsegment, count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING min(o_orderdate) <= DATE '1996-06-30')
        LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey GROUP BY 1""")
def _(orders, customer):
    cohort = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first")).where(
        F.to_date("first") <= F.lit(date(1996, 6, 30))
    )
    solvent = _keyed(customer.where(F.col("c_acctbal") > 0), "c_custkey", "o_custkey")
    return _count_by(cohort.join(solvent, "o_custkey", "left"), "c_mktsegment")


@add("J16_join_to_top_line", "orders lineitem customer",
     """SELECT p, c_mktsegment, count(*) AS n FROM orders
        JOIN (SELECT l_orderkey, l_partkey % 10 AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey) AS r FROM lineitem) l
          ON l_orderkey = o_orderkey AND r = 1 JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def _(orders, lineitem, customer):
    lines = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_extendedprice")
    top = first_per_group(lines, ["o_orderkey"], [F.desc("l_extendedprice"), F.col("l_partkey")])
    joined = orders.join(top, "o_orderkey").join(_keyed(customer, "c_custkey", "o_custkey"), "o_custkey")
    return _count_by(joined.withColumn("p", F.col("l_partkey") % 10), "p", "c_mktsegment")


@add("J17_orders_by_geography", "orders customer",
     f"""SELECT c_nationkey, count(*) AS orders, count(DISTINCT o_custkey) AS customers, sum(o_totalprice::{_M})::DOUBLE AS total
         FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def _(orders, customer):
    bought = _price(orders, "o_totalprice").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum("o_totalprice").alias("total")
    )
    located = bought.join(_keyed(customer, "c_custkey", "o_custkey"), "o_custkey")
    return located.groupBy("c_nationkey").agg(
        F.sum("orders").alias("orders"), F.count("*").alias("customers"), F.sum("total").alias("total")
    )


@add("J18_frame_merge", "orders lineitem part",
     """SELECT o_orderkey, l_linenumber, p_partkey, p_type FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'F'""")
def _(orders, lineitem, part):
    merged = (
        orders.where(F.col("o_orderstatus") == "F")
        .join(_keyed(lineitem, "l_orderkey", "o_orderkey"), "o_orderkey")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    return merged.select("o_orderkey", "l_linenumber", "p_partkey", "p_type")


@add("J19_anti_join", "customer orders",
     "SELECT o_custkey, count(*) AS rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1")
def _(customer, orders):
    return orphans(orders, "o_custkey", customer.where(F.col("c_acctbal") > 0), "c_custkey")


@add("J20_fan_out_guard", "orders lineitem events",
     """SELECT count(*) AS orders, sum(coalesce(q, 0))::BIGINT AS quantity, sum(coalesce(e, 0))::BIGINT AS events,
               sum(coalesce(q, 0) * greatest(coalesce(e, 0), 1))::BIGINT AS quantity_if_fanned_out
        FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity::BIGINT) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
        LEFT JOIN (SELECT event_id * 9 // 10 AS k, count(*) AS e FROM events GROUP BY 1) ON k = o_orderkey""")
def _(orders, lineitem, events):
    """Both sides reach order grain before they meet; the last column is what a row-level join would sum."""
    sold = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q")
    )
    seen = events.groupBy(F.expr("event_id * 9 div 10").alias("o_orderkey")).agg(F.count("*").alias("e"))
    joined = orders.select("o_orderkey").join(sold, "o_orderkey", "left").join(seen, "o_orderkey", "left")
    quantity, matched = numbers.zero_count("q"), numbers.zero_count("e")
    return joined.agg(
        F.count("*").alias("orders"), F.sum(quantity).alias("quantity"), F.sum(matched).alias("events"),
        F.sum(quantity * F.greatest(matched, F.lit(1))).alias("quantity_if_fanned_out"),
    )


# Aggregations -------------------------------------------------------------


@add("G1_sum_and_count", "lineitem", "SELECT l_orderkey, sum(l_quantity::BIGINT)::BIGINT AS quantity, count(*) AS n FROM lineitem GROUP BY 1")
def _(lineitem):
    return lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.count("*").alias("n")
    )


@add("G2_sum_of_expression", "lineitem",
     f"""SELECT l_suppkey, sum(l_extendedprice::{_M})::DOUBLE AS price, sum(l_extendedprice::{_M} + l_quantity::{_M})::DOUBLE AS gross, count(*) AS n
         FROM lineitem GROUP BY 1""")
def _(lineitem):
    lines = _price(_price(lineitem, "l_extendedprice"), "l_quantity")
    return lines.groupBy("l_suppkey").agg(
        F.sum("l_extendedprice").alias("price"),
        F.sum(F.col("l_extendedprice") + F.col("l_quantity")).alias("gross"), F.count("*").alias("n"),
    )


@add("G3_conditional_count", "orders",
     """SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS finished,
               count(*) FILTER (o_orderstatus = 'F') > 1 AS repeats FROM orders GROUP BY 1""")
def _(orders):
    finished = F.count_if(F.col("o_orderstatus") == "F")
    return orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), finished.alias("finished"), (finished > 1).alias("repeats")
    )


@add("G4_conditional_sum", "orders",
     f"""SELECT o_custkey, coalesce(sum(o_totalprice::{_M}) FILTER (o_orderstatus IN ('F', 'O')), 0)::DOUBLE AS earned FROM orders GROUP BY 1""")
def _(orders):
    counted = F.when(F.col("o_orderstatus").isin("F", "O"), F.col("o_totalprice")).otherwise(numbers.zero_money(F.lit(None)))
    return _price(orders, "o_totalprice").groupBy("o_custkey").agg(F.sum(counted).alias("earned"))


@add("G5_first_and_last_date", "orders",
     "SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1")
def _(orders):
    day = F.to_date("o_orderdate")
    return orders.groupBy("o_custkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@add("G6_latest_value", "orders",
     """SELECT o_custkey, o_orderstatus, o_orderpriority FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def _(orders):
    latest = F.max_by(F.struct("o_orderstatus", "o_orderpriority"), F.struct(*_BY_DATE))
    return orders.groupBy("o_custkey").agg(latest.alias("latest")).select("o_custkey", "latest.*")


@add("G7_days_since_last", "orders",
     "SELECT o_custkey, date_diff('day', max(o_orderdate)::DATE, DATE '2001-12-31')::INTEGER AS days FROM orders GROUP BY 1")
def _(orders):
    last = F.max(F.to_date("o_orderdate"))
    return orders.groupBy("o_custkey").agg(F.datediff(F.lit(date(2001, 12, 31)), last).alias("days"))


@add("G8_mean", "customer",
     f"SELECT c_nationkey, sum(c_acctbal::{_M})::DOUBLE / count(*) AS balance FROM customer GROUP BY 1")
def _(customer):
    return _price(customer, "c_acctbal").groupBy("c_nationkey").agg(mean("c_acctbal").alias("balance"))


@add("G9_any_value", "customer", "SELECT c_nationkey, min(c_mktsegment) AS segment FROM customer GROUP BY 1")
def _(customer):
    return customer.groupBy("c_nationkey").agg(F.min("c_mktsegment").alias("segment"))


@add("G10_count_distinct", "lineitem",
     "SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_returnflag || '/' || l_linestatus) AS states FROM lineitem GROUP BY 1")
def _(lineitem):
    """Two distinct counts: groups by both columns first, so that no row is
    copied per count, then one count from each side of the same groups."""
    state = F.concat("l_returnflag", F.lit("/"), "l_linestatus")
    pairs = lineitem.select("l_suppkey", "l_orderkey", state.alias("state")).distinct()
    orders = pairs.groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("orders"))
    states = pairs.groupBy("l_suppkey").agg(F.countDistinct("state").alias("states"))
    return orders.join(states, "l_suppkey")


@add("G10b_distinct_customers_of_quarters", "orders",
     """SELECT year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter, count(DISTINCT o_custkey) AS customers,
               count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1, 2""")
def _(orders):
    """Quarters from bitmaps of days: no order is read again for another range of days."""
    daily = daily_bitmaps(orders, F.to_date("o_orderdate"), F.col("o_custkey"))
    folder = f"{shared_folder(orders.sparkSession)}/catalog/bitmaps-{uuid.uuid4().hex}"
    stored = write_table(daily, folder)
    quarter = stored.select(F.year("day").alias("year"), F.quarter("day").alias("quarter"), "day", "bucket", "ids")
    days = quarter.groupBy("year", "quarter").agg(F.countDistinct("day").alias("days"))
    return distinct_ids(quarter, ["year", "quarter"], "customers").join(days, ["year", "quarter"])


@add("G11_rounded_sum", "lineitem",
     f"SELECT l_shipdate, round(sum(l_extendedprice::{_M}), 0)::DOUBLE AS whole, round(sum(l_extendedprice::{_M}), 2)::DOUBLE AS cents FROM lineitem GROUP BY 1")
def _(lineitem):
    total = F.sum("l_extendedprice")
    return _price(lineitem, "l_extendedprice").groupBy("l_shipdate").agg(
        F.round(total, 0).alias("whole"), F.round(total, 2).alias("cents")
    )


@add("G12_rate", "lineitem",
     "SELECT l_suppkey, round(100.0::DOUBLE * count(*) FILTER (l_returnflag = 'R') / count(*), 2) AS returned_pct FROM lineitem GROUP BY 1")
def _(lineitem):
    return lineitem.groupBy("l_suppkey").agg(percent_where(F.col("l_returnflag") == "R", 2).alias("returned_pct"))


@add("G13_ratio_of_aggregates", "orders",
     f"""SELECT o_orderpriority, round(sum(o_totalprice::{_M})::DOUBLE / count(*) FILTER (o_orderstatus = 'F'), 2) AS per_finished FROM orders GROUP BY 1""")
def _(orders):
    finished = F.count_if(F.col("o_orderstatus") == "F")
    return _price(orders, "o_totalprice").groupBy("o_orderpriority").agg(
        F.round(numbers.ratio(F.sum("o_totalprice"), finished), 2).alias("per_finished")
    )


@add("G14_median_element", "orders",
     "SELECT o_orderpriority, quantile_disc(o_totalprice, 0.5) AS p0 FROM orders GROUP BY 1")
def _(orders):
    return exact_percentiles(orders, ["o_orderpriority"], "o_totalprice", [0.5], 1000.0, interpolate=False)


@add("G15_percentile_profile", "lineitem",
     "SELECT l_returnflag, " + ", ".join(
         f"quantile_disc(l_extendedprice, {p}) AS p{i}" for i, p in enumerate((0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1)))
     + " FROM lineitem GROUP BY 1")
def _(lineitem):
    points = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1]
    return exact_percentiles(lineitem, ["l_returnflag"], "l_extendedprice", points, 500.0, interpolate=False)


def _digit_bounds(lines: str, points: tuple[float, ...]) -> str:
    """Bounds of quantiles of the price in cents, from buckets of three leading digits."""
    return f"""
      FROM (SELECT l_returnflag, low, high, count(*) AS n, sum(count(*)) OVER (PARTITION BY l_returnflag ORDER BY low)::BIGINT AS rank_high,
                   sum(count(*)) OVER (PARTITION BY l_returnflag)::BIGINT AS total
            FROM (SELECT l_returnflag, cents // step * step AS low, cents // step * step + step - 1 AS high
                  FROM (SELECT l_returnflag, cents, (10 ** greatest(length(cents::VARCHAR) - 3, 0))::BIGINT AS step
                        FROM (SELECT l_returnflag, (l_extendedprice::{_M} * 100)::BIGINT AS cents FROM {lines})))
            GROUP BY l_returnflag, low, high)
      JOIN (SELECT unnest({list(points)}::DECIMAL(10,9)[]) AS p) ON greatest(ceil(p * total), 1) BETWEEN rank_high - n + 1 AND rank_high"""


_BOUNDS = "l_returnflag, p::DOUBLE AS p, low, high, rank_high - n + 1 AS rank_low, rank_high, total"
_PROFILE = (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)


def _cents(name: str):
    return (F.col(name).cast(MONEY) * 100).cast("long")


@add("G15b_approximate_profile", "lineitem", f"SELECT {_BOUNDS} {_digit_bounds('lineitem', _PROFILE)}")
def _(lineitem):
    """One pass and a sketch of bounded size: values within 1 %, with the ranks they have."""
    return quantile_bounds(digit_counts(lineitem, ["l_returnflag"], _cents("l_extendedprice")), ["l_returnflag"], _PROFILE)


@add("G15c_profile_of_stored_days", "lineitem",
     f"SELECT 'all' AS days, {_BOUNDS} {_digit_bounds('lineitem', _PROFILE)} UNION ALL "
     f"SELECT '1996', {_BOUNDS} {_digit_bounds('(SELECT * FROM lineitem WHERE year(l_shipdate) = 1996)', _PROFILE)}")
def _(lineitem):
    """Facts are read once, into a sketch per day; ranges of days are profiled from these."""
    daily = digit_counts(
        lineitem.withColumn("day", F.col("l_shipdate").cast("date")), ["day", "l_returnflag"], _cents("l_extendedprice")
    )
    stored = write_table(daily, f"{shared_folder(lineitem.sparkSession)}/catalog/daily-sketches-{uuid.uuid4().hex}")
    ranges = {"all": stored, "1996": stored.where(F.year("day") == 1996)}
    parts = [
        quantile_bounds(merged(rows, ["l_returnflag"]), ["l_returnflag"], _PROFILE).select(F.lit(name).alias("days"), "*")
        for name, rows in ranges.items()
    ]
    return parts[0].unionByName(parts[1])


@add("G16_series_quartiles", "lineitem",
     """SELECT count(*) AS n, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.75) AS p75,
               round(100.0::DOUBLE * count(*) FILTER (l_quantity <= 30) / count(*), 1) AS within_30 FROM lineitem""")
def _(lineitem):
    quarters = exact_percentiles(lineitem, [], "l_quantity", [0.25, 0.5, 0.75], 10.0)
    named = quarters.withColumnsRenamed({"p0": "p25", "p1": "median", "p2": "p75"})
    shares = lineitem.agg(F.count("*").alias("n"), percent_where(F.col("l_quantity") <= 30, 1).alias("within_30"))
    return in_one_row(shares, named)


@add("G17_one_row_of_many_tables", "orders lineitem customer events",
     """SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lines,
               (SELECT count(DISTINCT c_nationkey) FROM customer) AS nations, (SELECT min(o_orderdate)::DATE FROM orders) AS first_day,
               (SELECT count(*) FROM events WHERE event_type = 'purchase') AS purchases""")
def _(orders, lineitem, customer, events):
    return in_one_row(
        orders.agg(F.count("*").alias("orders"), F.min(F.to_date("o_orderdate")).alias("first_day")),
        lineitem.agg(F.count("*").alias("lines")),
        customer.agg(F.countDistinct("c_nationkey").alias("nations")),
        events.agg(F.count_if(F.col("event_type") == "purchase").alias("purchases")),
    )


@add("G18_filter_on_aggregate", "orders",
     "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def _(orders):
    return _count_by(orders, "o_custkey").where(F.col("n") >= 12)


@add("G19_filter_on_group_key", "part",
     "SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2 HAVING p_type IN ('SMALL', 'PROMO')")
def _(part):
    return _count_by(part, "p_type", "p_brand").where(F.col("p_type").isin("SMALL", "PROMO"))


@add("G20_second_level_rollup", "orders customer nation",
     """SELECT n_regionkey, sum(customers)::BIGINT AS customers, sum(orders)::BIGINT AS orders FROM (
          SELECT c_nationkey, count(DISTINCT o_custkey) AS customers, count(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
        JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def _(orders, customer, nation):
    bought = orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))
    states = bought.join(_keyed(customer, "c_custkey", "o_custkey"), "o_custkey").groupBy(
        F.col("c_nationkey").alias("n_nationkey")
    ).agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"))
    return states.join(nation, "n_nationkey").groupBy("n_regionkey").agg(
        F.sum("customers").alias("customers"), F.sum("orders").alias("orders")
    )


@add("G21_yearly_sum", "orders",
     f"SELECT year(o_orderdate)::INTEGER AS year, sum(o_totalprice::{_M})::DOUBLE AS gmv FROM orders GROUP BY 1")
def _(orders):
    return _price(orders, "o_totalprice").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.sum("o_totalprice").alias("gmv")
    )


@add("G22_group_by_alias", "part", "SELECT substr(p_brand, 1, 7) AS family, count(*) AS n FROM part GROUP BY family")
def _(part):
    return _count_by(part.withColumn("family", F.substring("p_brand", 1, 7)), "family")


@add("G23_scalar_subquery", "orders lineitem",
     """SELECT o_orderpriority, count(*) AS n, (SELECT count(*) FROM lineitem) AS all_lines,
               count(*) < (SELECT count(*) FROM lineitem) AS fewer FROM orders GROUP BY 1""")
def _(orders, lineitem):
    lines = lineitem.agg(F.count("*").alias("n")).scalar()
    return _count_by(orders, "o_orderpriority").select(
        "o_orderpriority", "n", lines.alias("all_lines"), (F.col("n") < lines).alias("fewer")
    )


@add("G24_global_summary", "orders",
     f"""SELECT count(*) AS n, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day,
                round(sum(o_totalprice::{_M})::DOUBLE / count(*), 2) AS average FROM orders""")
def _(orders):
    day = F.to_date("o_orderdate")
    return _price(orders, "o_totalprice").agg(
        F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.round(mean("o_totalprice"), 2).alias("average"),
    )


# Windows ------------------------------------------------------------------


@add("W1_dedupe_keep_latest", "events",
     """SELECT event_id, user_id, event_type, ts FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CASE WHEN event_id % 37 > 0 THEN ts END DESC NULLS LAST, event_id) AS r FROM events)
        WHERE r = 1""")
def _(events):
    answered = events.withColumn("answered", F.when(F.col("event_id") % 37 > 0, F.col("ts")))
    latest = [F.col("answered").desc_nulls_last(), F.col("event_id")]
    return first_per_group(answered, ["user_id", "event_type"], latest).select(
        "event_id", "user_id", "event_type", "ts"
    )


@add("W2_median_per_partition", "customer",
     f"SELECT c_nationkey, quantile_cont(c_acctbal::{_M}::DOUBLE, 0.5) AS p0 FROM customer GROUP BY 1")
def _(customer):
    return exact_percentiles(_price(customer, "c_acctbal"), ["c_nationkey"], "c_acctbal", [0.5], 100)


@add("W3_rank_per_customer", "orders",
     """SELECT o_custkey, o_orderkey, n FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n <= 3""")
def _(orders):
    return ranked(orders, ["o_custkey"], [F.col(c) for c in _BY_DATE], 3, "n").select("o_custkey", "o_orderkey", "n")


@add("W4_top_line_per_order", "lineitem",
     """SELECT l_orderkey, l_partkey, l_extendedprice FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey) AS r FROM lineitem) WHERE r = 1""")
def _(lineitem):
    lines = lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    return first_per_group(lines, ["l_orderkey"], [F.desc("l_extendedprice"), F.col("l_partkey")])


@add("W5_top_customer_per_place", "customer",
     """SELECT c_nationkey, c_custkey, c_acctbal FROM (
          SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r = 1""")
def _(customer):
    kept = customer.select("c_nationkey", "c_custkey", "c_acctbal")
    return first_per_group(kept, ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")])


@add("W6_share_of_total", "orders",
     f"""SELECT o_orderpriority, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct,
                round(100.0::DOUBLE * (sum(o_totalprice::{_M})::DOUBLE / sum(sum(o_totalprice::{_M})) OVER ()::DOUBLE), 2) AS pct_value
         FROM orders GROUP BY 1""")
def _(orders):
    groups = _price(orders, "o_totalprice").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("value")
    )
    return groups.select(
        "o_orderpriority", "n", share_of_groups("n", 2).alias("pct"), share_of_groups("value", 2).alias("pct_value")
    )


@add("W6b_share_of_unbounded_groups", "orders",
     f"""SELECT o_custkey, round(100.0::DOUBLE * (sum(o_totalprice::{_M})::DOUBLE / (SELECT sum(o_totalprice::{_M}) FROM orders)::DOUBLE), 4) AS pct
         FROM orders GROUP BY 1""")
def _(orders):
    customers = _price(orders, "o_totalprice").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("value"))
    return customers.select("o_custkey", percent(F.col("value"), grand_total(customers, "value"), 4).alias("pct"))


@add("W8_head_shares", "orders",
     f"""SELECT round(100.0::DOUBLE * (sum(v) FILTER (r <= 1)::DOUBLE / sum(v)::DOUBLE), 3) AS top_1, round(100.0::DOUBLE * (sum(v) FILTER (r <= 10)::DOUBLE / sum(v)::DOUBLE), 3) AS top_10,
                round(100.0::DOUBLE * (sum(v) FILTER (r <= 100)::DOUBLE / sum(v)::DOUBLE), 3) AS top_100
         FROM (SELECT v, row_number() OVER (ORDER BY v DESC, o_custkey) AS r FROM (SELECT o_custkey, sum(o_totalprice::{_M}) AS v FROM orders GROUP BY 1))""")
def _(orders):
    customers = _price(orders, "o_totalprice").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))

    def head(n: int) -> DataFrame:
        return customers.orderBy(F.desc("v"), "o_custkey").limit(n).agg(F.sum("v").alias(f"h{n}"))

    row = in_one_row(customers.agg(F.sum("v").alias("total")), *[head(n) for n in (1, 10, 100)])
    return row.select(*[percent(F.col(f"h{n}"), F.col("total"), 3).alias(f"top_{n}") for n in (1, 10, 100)])


# Sorts, limits and set operations -----------------------------------------


@add("O1_global_sort", "customer", "SELECT c_custkey, c_acctbal FROM customer")
def _(customer):
    return customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@add("O2_top_n", "orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(orders):
    return orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@add("O3_head_and_tail", "orders",
     """(SELECT 'head' AS side, o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 6)
        UNION ALL (SELECT 'tail', o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey DESC LIMIT 6)""")
def _(orders):
    head = orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(6)
    tail = orders.orderBy("o_totalprice", F.desc("o_orderkey")).limit(6)
    return head.select(F.lit("head").alias("side"), "o_orderkey").unionAll(
        tail.select(F.lit("tail").alias("side"), "o_orderkey")
    )


@add("O4_head_of_grouped_result", "lineitem",
     f"""SELECT l_suppkey, l_returnflag, sum(l_extendedprice::{_M})::DOUBLE AS price FROM lineitem GROUP BY 1, 2
         ORDER BY price DESC, l_suppkey, l_returnflag LIMIT 50""")
def _(lineitem):
    grouped = _price(lineitem, "l_extendedprice").groupBy("l_suppkey", "l_returnflag").agg(
        F.sum("l_extendedprice").alias("price")
    )
    return grouped.orderBy(F.desc("price"), "l_suppkey", "l_returnflag").limit(50)


@add("O5_top_one_per_group", "part",
     """SELECT p_type, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r = 1""")
def _(part):
    best = first_per_group(part, ["p_type"], [F.desc("p_retailprice"), F.col("p_partkey")])
    return best.select("p_type", "p_partkey")


@add("O6_preview", "supplier", "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 12")
def _(supplier):
    return supplier.select("s_suppkey", "s_name").orderBy("s_suppkey").limit(12)


@add("U1_union_of_profiles", "orders customer",
     """SELECT 'order total' AS measure, quantile_disc(o_totalprice, 0.5) AS p0 FROM orders
        UNION ALL SELECT 'balance', quantile_disc(c_acctbal, 0.5) FROM customer""")
def _(orders, customer):
    values = orders.select(F.lit("order total").alias("measure"), F.col("o_totalprice").alias("v")).unionByName(
        customer.select(F.lit("balance").alias("measure"), F.col("c_acctbal").alias("v"))
    )
    return exact_percentiles(values, ["measure"], "v", [0.5], 1000.0, interpolate=False)


@add("U2_set_difference", "customer orders",
     "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(customer, orders):
    finished = orders.where(F.col("o_orderstatus") == "F").select("o_custkey")
    return customer.select("c_custkey").subtract(finished)


@add("U3_distinct_by_key", "lineitem", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _(lineitem):
    return lineitem.select("l_suppkey", "l_returnflag").dropDuplicates(["l_suppkey", "l_returnflag"])


QUERIES, ORACLES = registry.queries, registry.oracles
