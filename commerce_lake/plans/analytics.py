"""Analyses over the marts. Each takes the model graph and returns a DataFrame.

Two habits keep these safe on very uneven data: a fact is summed per key
before it is joined on that key, and totals or ranks are taken over grouped
results, never over fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.functions import labels
from commerce_lake.functions.dates import day_gap, elapsed_seconds
from commerce_lake.functions.numbers import (
    COORDINATE, MONEY, double, mean, percent, percent_where, rounded, zero_money,
)
from commerce_lake.functions.text import label_head, label_tail, place_label
from commerce_lake.operators.percentiles import exact_percentiles
from commerce_lake.operators.prefix import running_sums
from commerce_lake.operators.ranking import first_per_group, ranked
from commerce_lake.operators.shares import (
    grand_total, in_one_row, running_share, share_of_groups,
)
from commerce_lake.plans.models import Models
from commerce_lake.sources.schema import RAW_TABLES

PURCHASE_ORDER = ("order_purchase_timestamp", "order_id")


def _purchase_order() -> list[Column]:
    return [F.col(c) for c in PURCHASE_ORDER]


# Overview ---------------------------------------------------------------


def headline_metrics(m: Models) -> DataFrame:
    """All headline numbers in one row; each fact is read once for its share."""
    orders = m.fct_orders
    revenue = F.col("is_revenue_order")
    delivered_known = F.col("is_late").isNotNull()
    plausible = F.col("delivery_days").between(0, m.params.plausible_delivery_days)
    late_days = day_gap("order_estimated_delivery_date", "order_delivered_customer_date")

    def revenue_sum(name: str) -> Column:
        return F.sum(F.when(revenue, F.col(name)))

    from_orders = orders.agg(
        F.count("*").alias("orders_total"),
        F.min("order_purchase_date").alias("first_order_date"),
        F.max("order_purchase_date").alias("last_order_date"),
        rounded(revenue_sum("item_price_total")).alias("product_revenue_brl"),
        rounded(revenue_sum("freight_value_total")).alias("freight_brl"),
        rounded(revenue_sum("item_gross_total")).alias("gmv_incl_freight_brl"),
        F.count_if(revenue).alias("revenue_orders"),
        percent_where(revenue, 1).alias("revenue_orders_pct"),
        F.round(double(revenue_sum("item_price_total")) / F.count_if(revenue), 2).alias("avg_order_value_brl"),
        F.round(mean(F.when(revenue, F.col("item_count"))), 2).alias("avg_items_per_order"),
        percent_where(F.col("order_delivered_customer_date").isNotNull(), 1).alias("pct_orders_delivered"),
        percent(F.count_if(F.col("is_late")), F.count("is_late"), 1).alias("late_rate_of_delivered_pct"),
        F.round(F.avg(F.when(plausible, F.col("delivery_days"))), 1).alias("avg_delivery_days"),
        F.round(mean(F.when(delivered_known, late_days)), 1).alias("avg_days_late_vs_promise"),
        # Durations are whole hours up to 180 days: at most 4,321 values to keep.
        F.round(F.percentile(F.when(plausible, F.col("delivery_days")), 0.5), 1).alias("median_delivery_days"),
    )
    # One pass by seller and product, then one by each, instead of a row copy per
    # distinct count. Both need the lines, so the facts are joined and summed once.
    sold = m.fct_order_items.groupBy("seller_key", "product_key").agg(F.count("*").alias("lines"))

    def with_sales(key: str, name: str, *more: Column) -> DataFrame:
        lines = sold.groupBy(key).agg(F.sum("lines").alias("lines"))
        return lines.agg(F.count_if(F.col(key).isNotNull() & (F.col("lines") > 0)).alias(name), *more)

    from_items = in_one_row(
        with_sales("seller_key", "sellers_with_sales", F.sum("lines").alias("order_lines_total")),
        with_sales("product_key", "products_with_sales"),
    )
    places = m.dim_customer.groupBy("customer_city", "customer_state").agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("order_count") > 1).alias("placed_again"),
        F.count_if(F.col("delivered_order_count") > 1).alias("delivered_again"),
        F.sum("order_count").alias("orders"),
        F.sum("lifetime_revenue").alias("revenue"),
    )
    customers = F.sum("customers")
    from_customers = places.agg(
        customers.alias("customers_total"),
        F.countDistinct("customer_state").alias("customer_states"),
        F.count(place_label("customer_city", "customer_state", "/")).alias("customer_city_values"),
        percent(F.sum("placed_again"), customers, 2).alias("repeat_rate_placed_pct"),
        percent(F.sum("delivered_again"), customers, 2).alias("repeat_rate_delivered_pct"),
        F.round(double(F.sum("orders")) / customers, 3).alias("avg_orders_per_customer"),
        F.round(double(F.sum("revenue")) / customers, 2).alias("avg_lifetime_revenue_brl"),
    )
    from_payments = m.fct_payments.agg(
        rounded(F.sum("payment_value")).alias("payments_received_brl"),
        F.round(mean("payment_installments"), 2).alias("avg_installments"),
        percent_where(F.col("payment_installments") > 1, 1).alias("pct_paid_in_installments"),
    )
    from_reviews = m.fct_reviews.agg(
        F.countDistinct("order_id").alias("_reviewed_orders"),
        F.round(mean("review_score"), 2).alias("avg_review_score"),
        percent_where(F.col("review_score") == 5, 1).alias("pct_5_star"),
        percent_where(F.col("review_score") <= 2, 1).alias("pct_1_2_star"),
        F.round(F.avg("review_response_days"), 1).alias("avg_review_response_days"),
    )
    values = m.dim_customer.select(double("lifetime_revenue").alias("value"))
    median_value = exact_percentiles(values, [], "value", [0.5], 10.0, interpolate=False).select(
        F.round("p0", 2).alias("median_lifetime_revenue_brl")
    )
    joined = in_one_row(from_orders, from_items, from_customers, from_payments, from_reviews, median_value)
    return joined.withColumn(
        "pct_orders_with_review", percent(F.col("_reviewed_orders"), F.col("orders_total"), 1)
    ).drop("_reviewed_orders")


PROFILE_POINTS = {"min": 0, "p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99, "max": 1}


def percentile_profile(m: Models) -> DataFrame:
    """Percentiles of six measures, in one pass over each table."""
    revenue = F.col("is_revenue_order")
    plausible = F.col("delivery_days").between(0, m.params.plausible_delivery_days)

    def measured(df: DataFrame, *measures: tuple[str, Column]) -> DataFrame:
        pairs = [F.struct(F.lit(name).alias("measure"), double(value).alias("value")) for name, value in measures]
        return df.select(F.inline(F.array(*pairs)))

    # Measure names that appear in the result.
    values = (
        measured(
            m.fct_orders,
            ("order product value (R$)", F.when(revenue, F.col("item_price_total"))),
            ("freight per order (R$)", F.when(revenue, F.col("freight_value_total"))),
            ("items per order", F.when(revenue, F.col("item_count"))),
            ("delivery days (capped 0-180)", F.when(plausible, F.col("delivery_days"))),
        )
        .unionAll(measured(m.fct_reviews, ("review score (1-5)", F.col("review_score"))))
        .unionAll(
            measured(m.dim_customer, ("lifetime revenue per customer (R$)", F.col("lifetime_revenue")))
        )
    )
    points = exact_percentiles(
        values, ["measure"], "value", list(PROFILE_POINTS.values()), 10.0, interpolate=False
    )
    return points.select(
        "measure", *[F.round(f"p{i}", 2).alias(name) for i, name in enumerate(PROFILE_POINTS)]
    )


def review_score_distribution(m: Models) -> DataFrame:
    scores = m.fct_reviews.groupBy("review_score").agg(F.count("*").alias("reviews"))
    return scores.withColumn("pct", share_of_groups("reviews", 1)).orderBy("review_score")


def mean_review_score(m: Models) -> DataFrame:
    """Mean weighted by the score distribution."""
    scores = m.fct_reviews.groupBy("review_score").agg(F.count("*").alias("reviews"))
    weighted = F.sum(F.col("review_score") * F.col("reviews"))
    return scores.agg(F.round(double(weighted) / F.sum("reviews"), 2).alias("avg_score"))


def order_status_funnel(m: Models) -> DataFrame:
    statuses = m.fct_orders.groupBy("order_status").agg(
        F.count("*").alias("orders"), rounded(F.sum("item_price_total")).alias("product_revenue")
    )
    return statuses.select(
        "order_status", "orders", share_of_groups("orders", 2).alias("pct_orders"), "product_revenue"
    ).orderBy(F.desc("orders"), "order_status")


def monthly_revenue(m: Models) -> DataFrame:
    """Orders are summed per day before they meet the calendar."""
    days = (
        m.fct_orders.where("is_revenue_order")
        .groupBy(F.col("order_purchase_date").alias("date_key"))
        .agg(F.count("*").alias("orders"), F.sum("item_price_total").alias("revenue"))
    )
    months = days.join(m.dim_date, "date_key").where(
        F.col("year_month") >= m.params.trend_start.strftime("%Y-%m")
    )
    return (
        months.groupBy("year_month", "is_complete_month")
        .agg(F.sum("orders").alias("orders"), rounded(F.sum("revenue")).alias("product_revenue"))
        .orderBy("year_month")
    )


def payment_mix(m: Models) -> DataFrame:
    kinds = m.fct_payments.groupBy("payment_type").agg(
        F.count("*").alias("payments"),
        rounded(F.sum("payment_value")).alias("total_value"),
        F.round(mean("payment_installments"), 1).alias("avg_installments"),
    )
    return kinds.withColumn("pct_of_payments", share_of_groups("payments", 1)).select(
        "payment_type", "payments", "pct_of_payments", "total_value", "avg_installments"
    ).orderBy(F.desc("payments"), "payment_type")


# Delivery ---------------------------------------------------------------


def _delivered_revenue_orders(m: Models) -> DataFrame:
    bucket = labels.lateness(
        F.col("is_late"), day_gap("order_estimated_delivery_date", "order_delivered_customer_date")
    )
    return m.fct_orders.where(F.col("is_late").isNotNull() & F.col("is_revenue_order")).withColumn(
        "delivery_bucket", bucket
    )


def reviews_by_lateness(m: Models) -> DataFrame:
    score = F.col("review_score")
    per_order = m.fct_reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("scored"),
        F.count_if(score <= 2).alias("low"),
        F.count_if(score == 5).alias("top"),
    )
    rated = _delivered_revenue_orders(m).select("order_id", "delivery_bucket").join(per_order, "order_id")
    reviews = F.sum("reviews")
    return (
        rated.groupBy("delivery_bucket")
        .agg(
            reviews.alias("orders"),
            F.round(double(F.sum("score_sum")) / F.sum("scored"), 2).alias("avg_review_score"),
            percent(F.sum("low"), reviews, 1).alias("dissatisfied_rate_pct"),
            percent(F.sum("top"), reviews, 1).alias("five_star_pct"),
        )
        .orderBy("delivery_bucket")
    )


def _first_orders(m: Models) -> DataFrame:
    """First order of each customer, kept if it was placed by the cut-off."""
    placed = m.fct_orders.select("customer_key", "order_purchase_date", "is_late", *PURCHASE_ORDER)
    first = first_per_group(placed, ["customer_key"], _purchase_order())
    return first.where(F.col("order_purchase_date") <= F.lit(m.params.cohort_cutoff))


def value_by_first_experience(m: Models) -> DataFrame:
    customers = m.dim_customer.select("customer_key", "order_count", "lifetime_revenue")
    cohort = _first_orders(m).select(
        "customer_key", labels.first_experience(F.col("is_late")).alias("first_experience")
    )
    return (
        cohort.join(customers, "customer_key", "left")
        .groupBy("first_experience")
        .agg(
            F.count("*").alias("customers"),
            percent_where(F.col("order_count") > 1, 2).alias("repeat_rate_pct"),
            F.round(mean("lifetime_revenue"), 2).alias("avg_lifetime_revenue"),
        )
        .orderBy("first_experience")
    )


def late_rate_by_month(m: Models) -> DataFrame:
    days = (
        m.fct_orders.where(F.col("is_late").isNotNull() & F.col("is_revenue_order"))
        .groupBy(F.col("order_purchase_date").alias("date_key"))
        .agg(F.count("*").alias("delivered"), F.count_if("is_late").alias("late"))
    )
    complete = m.dim_date.where(
        F.col("is_complete_month") & (F.col("date_key") >= F.lit(m.params.trend_start))
    ).select("date_key", "year_month")
    return (
        days.join(complete, "date_key")
        .groupBy("year_month")
        .agg(
            F.sum("delivered").alias("delivered_orders"),
            percent(F.sum("late"), F.sum("delivered"), 1).alias("late_rate_pct"),
        )
        .orderBy("year_month")
    )


def worst_late_months(m: Models) -> DataFrame:
    return late_rate_by_month(m).where(F.col("late_rate_pct") >= m.params.late_month_pct)


def mean_monthly_late_rate(m: Models) -> DataFrame:
    return late_rate_by_month(m).agg(F.round(F.avg("late_rate_pct"), 1).alias("mean_late_rate_pct"))


def revenue_through_late_delivery(m: Models) -> DataFrame:
    late = F.sum(F.when(F.col("is_late"), F.col("item_price_total")).otherwise(zero_money(F.lit(None))))
    revenue = F.sum("item_price_total")
    return m.fct_orders.where(F.col("is_late").isNotNull() & F.col("is_revenue_order")).agg(
        F.count("*").alias("delivered_revenue_orders"),
        percent_where(F.col("is_late"), 2).alias("late_order_rate_pct"),
        rounded(revenue).alias("product_revenue"),
        rounded(late).alias("revenue_via_late_delivery"),
        percent(late, revenue, 2).alias("pct_revenue_via_late"),
    )


def revenue_by_lateness(m: Models) -> DataFrame:
    buckets = _delivered_revenue_orders(m).groupBy("delivery_bucket").agg(
        F.count("*").alias("orders"), F.sum("item_price_total").alias("exact")
    )
    return buckets.select(
        "delivery_bucket", "orders", rounded("exact").alias("revenue"),
        share_of_groups("exact", 2).alias("pct_revenue"),
    ).orderBy("delivery_bucket")


# Retention --------------------------------------------------------------


def order_count_segments(m: Models) -> DataFrame:
    segments = m.dim_customer.groupBy(labels.order_segment(F.col("order_count")).alias("segment")).agg(
        F.count("*").alias("customers"),
        F.sum("lifetime_revenue").alias("exact"),
        F.round(mean("lifetime_revenue"), 2).alias("avg_lifetime_revenue"),
    )
    return segments.select(
        "segment",
        "customers",
        share_of_groups("customers", 2).alias("pct_customers"),
        rounded("exact").alias("revenue"),
        share_of_groups("exact", 2).alias("pct_revenue"),
        "avg_lifetime_revenue",
    ).orderBy("segment")


def second_order_gaps(m: Models) -> DataFrame:
    """Days between first and second order, one row per repeat customer."""
    placed = m.fct_orders.select("customer_key", "order_purchase_date", *PURCHASE_ORDER)
    first_two = ranked(placed, ["customer_key"], _purchase_order(), 2, "position")

    def date_of(position: int) -> Column:
        return F.max(F.when(F.col("position") == position, F.col("order_purchase_date")))

    pairs = first_two.groupBy("customer_key").agg(date_of(1).alias("first"), date_of(2).alias("second"))
    return pairs.where(F.col("second").isNotNull()).select(
        F.datediff("second", "first").alias("gap_days")
    )


def second_order_timing(m: Models) -> DataFrame:
    """Quartiles and early shares; there are no more distinct gaps than days."""
    days = second_order_gaps(m).groupBy("gap_days").agg(F.count("*").alias("n"))
    quartiles = F.percentile("gap_days", F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)]), F.col("n"))
    customers = F.sum("n")

    def within(limit: int) -> Column:
        return percent(F.sum(F.when(F.col("gap_days") <= limit, F.col("n")).otherwise(0)), customers, 1)

    return days.agg(
        customers.alias("repeat_customers"),
        quartiles.alias("q"),
        *[within(limit).alias(f"within_{limit}_days_pct") for limit in (30, 60, 90)],
    ).select(
        "repeat_customers",
        F.element_at("q", 1).alias("p25_gap_days"),
        F.element_at("q", 2).alias("median_gap_days"),
        F.element_at("q", 3).alias("p75_gap_days"),
        "within_30_days_pct", "within_60_days_pct", "within_90_days_pct",
    )


def second_order_histogram(m: Models, bins: int = 37, cap: int = 365) -> DataFrame:
    """Equal-width bins between the smallest and largest capped gap."""
    days = (
        second_order_gaps(m)
        .groupBy(F.least("gap_days", F.lit(cap)).alias("gap"))
        .agg(F.count("*").alias("n"))
    )
    everything = Window.partitionBy()
    low, high = F.min("gap").over(everything), F.max("gap").over(everything)
    bin_number = F.when(low == high, F.lit(bins // 2 + 1)).otherwise(
        F.least(F.floor((F.col("gap") - low) * bins / (high - low)) + 1, F.lit(bins))
    )
    return (
        days.select(bin_number.cast("int").alias("bin"), "gap", "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("customers"), F.min("gap").alias("min_gap_days"), F.max("gap").alias("max_gap_days"))
        .orderBy("bin")
    )


def repeat_rate_by_first_category(m: Models) -> DataFrame:
    """Category of a first order is that of its highest-priced line."""
    # First orders meet their lines before lines meet products or are ranked.
    first = _first_orders(m).select("customer_key", F.col("order_id").alias("first_order"))
    lines = m.fct_order_items.select("order_id", "product_key", "price", "order_item_id")
    named = lines.join(first, F.col("order_id") == F.col("first_order")).join(
        m.dim_product.select("product_key", F.col("product_category_name_english").alias("category")),
        "product_key",
    )
    top_line = first_per_group(named, ["order_id"], [F.desc("price"), F.col("order_item_id")])
    customers = m.dim_customer.select("customer_key", "order_count")
    by_category = (
        top_line.select("customer_key", "category")
        .join(customers, "customer_key")
        .groupBy("category")
        .agg(
            F.count("*").alias("customers"),
            percent_where(F.col("order_count") > 1, 2).alias("repeat_rate_pct"),
        )
    )
    return by_category.where(F.col("customers") >= m.params.category_min_customers).orderBy(
        F.desc("repeat_rate_pct"), "category"
    )


def best_and_worst_categories(m: Models, n: int = 6) -> DataFrame:
    rates = repeat_rate_by_first_category(m)
    best = rates.orderBy(F.desc("repeat_rate_pct"), "category").limit(n)
    worst = rates.orderBy("repeat_rate_pct", F.desc("category")).limit(n)
    return best.select(F.lit("best").alias("side"), "*").unionAll(worst.select(F.lit("worst"), "*"))


def value_by_state(m: Models) -> DataFrame:
    states = m.dim_customer.groupBy(F.col("customer_state").alias("state")).agg(
        F.count("*").alias("customers"),
        percent_where(F.col("order_count") > 1, 2).alias("repeat_rate_pct"),
        F.round(mean("lifetime_revenue"), 2).alias("avg_lifetime_revenue"),
    )
    return states.where(F.col("customers") >= m.params.state_min_customers).orderBy(
        F.desc("customers"), "state"
    )


def state_rate_range(m: Models) -> DataFrame:
    return value_by_state(m).agg(
        F.min("repeat_rate_pct").alias("lowest_pct"), F.max("repeat_rate_pct").alias("highest_pct")
    )


def recency_buckets(m: Models) -> DataFrame:
    bucket = labels.recency(F.col("recency_days"))
    return (
        m.dim_customer.groupBy(bucket.alias("time_since_last_order"))
        .agg(
            F.count("*").alias("customers"),
            percent_where(F.col("order_count") > 1, 2).alias("repeat_rate_pct"),
            rounded(F.sum("lifetime_revenue")).alias("revenue_to_date"),
        )
        .orderBy("time_since_last_order")
    )


def repeat_rate_what_if(m: Models) -> DataFrame:
    """Extra customers and revenue if more of the base ordered again."""
    segment, average = F.col("segment"), F.col("avg_lifetime_revenue")
    one, two = labels.ORDER_SEGMENTS[0][1], labels.ORDER_SEGMENTS[1][1]
    base = order_count_segments(m).agg(
        F.sum("customers").alias("customers"),
        F.sum(F.when(segment != one, F.col("customers")).otherwise(0)).alias("repeaters"),
        (F.max(F.when(segment == two, average)) - F.max(F.when(segment == one, average))).alias("incremental"),
    )
    targets = F.array(*[F.lit(t) for t in m.params.repeat_targets])
    extra = F.col("customers") * (F.col("target") - F.col("repeaters") / F.col("customers"))
    return base.withColumn("target", F.explode(targets)).select(
        "target",
        F.round(100.0 * F.col("repeaters") / F.col("customers"), 1).alias("repeat_rate_now_pct"),
        F.round("incremental", 2).alias("incremental_value"),
        F.round(extra, 0).alias("extra_repeat_customers"),
        F.round(extra * F.col("incremental"), 0).alias("extra_revenue"),
    )


# Geography --------------------------------------------------------------


def _revenue_by_customer(m: Models) -> DataFrame:
    """Revenue orders summed per customer, with the customer's place.

    One row per buyer, so counting rows counts distinct customers.
    """
    bought = (
        m.fct_orders.where("is_revenue_order")
        .groupBy("customer_key")
        .agg(F.count("*").alias("orders"), F.sum("item_price_total").alias("revenue"))
    )
    return bought.join(m.dim_customer.select("customer_key", "customer_city", "customer_state"), "customer_key")


def _by_place(m: Models, place: Column, name: str) -> DataFrame:
    return _revenue_by_customer(m).groupBy(place.alias(name)).agg(
        F.sum("orders").alias("orders"),
        F.count("*").alias("customers"),
        F.sum("revenue").alias("exact"),
    )


def revenue_by_state(m: Models) -> DataFrame:
    states = _by_place(m, F.col("customer_state"), "state")
    shown = states.select(
        "state", "orders", "customers", rounded("exact").alias("revenue"),
        share_of_groups("exact", 2).alias("pct_revenue"),
        F.round(double("exact") / F.col("orders"), 2).alias("avg_order_value"),
    )
    running = running_share("pct_revenue", [F.desc("revenue"), F.col("state")])
    return (
        shown.join(m.state_regions, "state", "left")
        .select(
            "state", "region", "orders", "customers", "revenue", "pct_revenue", "avg_order_value",
            running.alias("cum_pct_revenue"),
        )
        .orderBy(F.desc("revenue"), "state")
    )


def revenue_by_region(m: Models) -> DataFrame:
    regions = (
        revenue_by_state(m)
        .where(F.col("region").isNotNull())
        .groupBy("region")
        .agg(*[F.sum(c).alias(c) for c in ("orders", "customers", "revenue")])
        .withColumn("pct_revenue", share_of_groups("revenue", 2))
    )
    running = running_share("pct_revenue", [F.desc("revenue"), F.col("region")])
    return regions.select(
        "region", "orders", "customers", "revenue", "pct_revenue",
        running.alias("cum_pct_revenue"),
        F.round(F.col("revenue") / F.col("orders"), 2).alias("avg_order_value"),
    ).orderBy(F.desc("revenue"), "region")


def region_volume_and_value(m: Models) -> DataFrame:
    return revenue_by_region(m).select("region", "orders", "avg_order_value").orderBy(
        F.desc("orders"), "region"
    )


def _cities(m: Models) -> DataFrame:
    return _by_place(m, place_label("customer_city", "customer_state"), "city")


def top_cities(m: Models) -> DataFrame:
    """Leading cities with their running share of all revenue."""
    cities = _cities(m).select("city", "orders", "customers", "exact")
    shown = cities.select(
        "city", "orders", "customers", rounded("exact").alias("revenue"),
        percent(F.col("exact"), grand_total(cities, "exact"), 2).alias("pct_revenue"),
    )
    leading = shown.orderBy(F.desc("revenue"), "city").limit(m.params.pareto_cities)
    running = running_share("pct_revenue", [F.desc("revenue"), F.col("city")])
    return (
        leading.withColumn("state", label_tail("city"))
        .join(m.state_regions, "state", "left")
        .select(
            "city", "region", "orders", "customers", "revenue", "pct_revenue",
            running.alias("cum_pct_revenue"),
            label_head("city").alias("city_label"),
        )
        .orderBy(F.desc("revenue"), "city")
    )


def running_city_share(m: Models) -> DataFrame:
    """Every city, by falling revenue, with the share of all revenue up to it.

    Cities grow with the data, so the running sums are taken by ranges. Shares
    are of exact sums and rounded last."""
    cities = _cities(m).select("city", "orders", "exact")
    summed = running_sums(cities, [F.desc("exact"), F.col("city")], {"so_far": "exact", "orders_so_far": "orders"})
    total = cities.agg(F.sum("exact").alias("total")).scalar()
    return summed.select(
        "city", "orders", rounded("exact").alias("revenue"), percent(F.col("so_far"), total, 2).alias("cum_pct_revenue"),
        "orders_so_far",
    )


def revenue_concentration(m: Models) -> DataFrame:
    """Share of the largest cities and size of the tail, in one row."""
    cities = _cities(m).select("city", "orders", F.col("exact").alias("revenue"))
    in_tail = F.col("orders") <= m.params.tail_orders
    whole = cities.agg(
        F.count("*").alias("city_values"),
        F.count_if(F.col("orders") == 1).alias("one_order_cities"),
        F.count_if(in_tail).alias("tail_cities"),
        percent(F.sum(F.when(in_tail, F.col("revenue"))), F.sum("revenue"), 1).alias("tail_revenue_pct"),
        F.sum("revenue").alias("_total"),
    )
    # Sorting on all columns keeps both uses of the cities alike, so Spark
    # computes them once.
    by_size = [F.desc("revenue"), F.desc("orders"), F.col("city")]
    leading = cities.orderBy(*by_size).limit(max(m.params.head_sizes))
    position = F.row_number().over(Window.orderBy(*by_size))
    heads = leading.withColumn("position", position).agg(
        *[
            F.sum(F.when(F.col("position") <= n, F.col("revenue"))).alias(f"_top_{n}")
            for n in m.params.head_sizes
        ]
    )
    row = in_one_row(whole, heads)
    shares = [
        percent(F.col(f"_top_{n}"), F.col("_total"), 1).alias(f"top_{n}_pct") for n in m.params.head_sizes
    ]
    return row.select(
        *shares, "city_values", "one_order_cities", "tail_cities",
        F.coalesce("tail_revenue_pct", F.lit(0.0)).alias("tail_revenue_pct"),
    )


def city_tiers(m: Models) -> DataFrame:
    """City count against revenue for three tiers.

    Leading cities may also be in the tail; the middle is what is in neither.
    """
    cities = _cities(m).select("city", "orders", F.col("exact").alias("revenue"))
    revenue, in_tail = F.col("revenue"), F.col("orders") <= m.params.tail_orders

    def measures(prefix: str) -> list[Column]:
        return [
            F.count("*").alias(f"{prefix}_n"),
            F.coalesce(F.sum(revenue), F.lit(0)).alias(f"{prefix}_r"),
            F.count_if(in_tail).alias(f"{prefix}_tail_n"),
            F.coalesce(F.sum(F.when(in_tail, revenue)), F.lit(0)).alias(f"{prefix}_tail_r"),
        ]

    leading = cities.orderBy(F.desc("revenue"), "city").limit(m.params.pareto_cities)
    sums = in_one_row(cities.agg(*measures("all")), leading.agg(*measures("top")))

    def neither(kind: str) -> Column:
        return F.col(f"all_{kind}") - F.col(f"top_{kind}") - F.col(f"all_tail_{kind}") + F.col(f"top_tail_{kind}")

    tiers = (
        (labels.tier_top(m.params), F.col("top_n"), F.col("top_r")),
        (labels.tier_mid(m.params), neither("n"), neither("r")),
        (labels.tier_tail(m.params), F.col("all_tail_n"), F.col("all_tail_r")),
    )
    rows = [
        F.struct(
            F.lit(name).alias("tier"),
            n.alias("n_cities"),
            percent(r, F.col("all_r"), 1).alias("revenue_pct"),
            percent(n, F.col("all_n"), 1).alias("cities_pct"),
        )
        for name, n, r in tiers
    ]
    return sums.select(F.inline(F.array(*rows)))


# Dashboards -------------------------------------------------------------


def cities_with_top_customer(m: Models) -> DataFrame:
    """Cities by lifetime revenue, each with its most valuable customer."""
    located = m.dim_customer.where(
        F.col("customer_city").isNotNull()
        & F.col("customer_latitude").isNotNull()
        & F.col("customer_longitude").isNotNull()
    )
    revenue = F.col("lifetime_revenue")
    best = F.min_by(
        F.struct("customer_key", "lifetime_revenue"),
        F.struct(revenue.isNull(), (-revenue).alias("descending"), F.col("customer_key")),
    )
    cities = located.groupBy(F.col("customer_city").alias("name")).agg(
        mean(F.col("customer_latitude").cast(COORDINATE)).alias("latitude"),
        mean(F.col("customer_longitude").cast(COORDINATE)).alias("longitude"),
        F.count("*").alias("customer_count"),
        F.sum("lifetime_revenue").alias("total_lifetime_revenue"),
        best.alias("best"),
    )
    return (
        cities.select(
            "name", "latitude", "longitude", "customer_count", "total_lifetime_revenue",
            F.col("best.customer_key").alias("top_customer_key"),
            F.col("best.lifetime_revenue").alias("top_customer_lifetime_revenue"),
        )
        .orderBy(F.desc("total_lifetime_revenue"), "name")
        .limit(m.params.top_cities)
    )


def cities_json(m: Models) -> DataFrame:
    """The ranking as JSON records, decimals as plain numbers."""
    cities = cities_with_top_customer(m)
    typed = cities.withColumns(
        {c: double(c) for c in ("total_lifetime_revenue", "top_customer_lifetime_revenue")}
    )
    return typed.select("name", F.to_json(F.struct(*typed.columns)).alias("city"))


def revenue_by_category_and_city(m: Models) -> DataFrame:
    """Lines of the chosen categories are summed per customer before places join."""
    chosen = m.dim_product.where(
        F.col("product_category_name_english").isin(*m.params.dashboard_categories)
    ).select("product_key", "product_category_name_english")
    bought = (
        m.fct_order_items.select("customer_key", "product_key", "line_gross_value")
        .join(chosen, "product_key")
        .groupBy("customer_key", "product_category_name_english")
        .agg(F.sum("line_gross_value").alias("revenue"))
    )
    return (
        bought.join(m.dim_customer.select("customer_key", "customer_city"), "customer_key")
        .groupBy("customer_city", "product_category_name_english")
        .agg(F.sum("revenue").alias("life_revenue"))
        .orderBy(F.desc("life_revenue"), "customer_city", "product_category_name_english")
    )


# Orders inside the promised date ------------------------------------------


def sla_sales(m: Models) -> DataFrame:
    """Wide line table of orders delivered by the promised date; durations in seconds."""
    approved, carrier = "order_approved_at", "order_delivered_carrier_date"
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    orders, items, products = (
        m.raw[name].select(*RAW_TABLES[name].schema.names) for name in ("orders", "order_items", "products")
    )
    kept = orders.where(F.col(delivered) <= F.col(promised))
    timed = kept.select(
        "*",
        elapsed_seconds(approved, carrier).alias("org_to_carrier_time"),
        elapsed_seconds(carrier, delivered).alias("carrier_to_customer_time"),
        elapsed_seconds(approved, delivered).alias("actual_arrival_time"),
        F.lit(True).alias("apply_SLA"),
        elapsed_seconds(promised, delivered).alias("delivery_delay"),
    )
    lines = items.withColumns({c: F.col(c).cast(MONEY) for c in ("price", "freight_value")})
    purchase = "order_purchase_timestamp"
    return (
        timed.join(lines, "order_id")
        .join(products, "product_id")
        .withColumns({"month": F.month(purchase), "year": F.year(purchase)})
    )


def yearly_gmv(m: Models) -> DataFrame:
    """Value of lines inside the promise by year of purchase, summed per
    product and year before products, which must exist, are looked up."""
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    kept = m.raw["orders"].where(F.col(delivered) <= F.col(promised)).select(
        "order_id", F.year("order_purchase_timestamp").alias("year")
    )
    by_order = m.raw["order_items"].groupBy("order_id", "product_id").agg(F.sum(F.col("price").cast(MONEY)).alias("gmv"))
    by_product = by_order.join(kept, "order_id").groupBy("product_id", "year").agg(F.sum("gmv").alias("gmv"))
    return (
        by_product.join(m.raw["products"].select("product_id"), "product_id")
        .groupBy("year").agg(F.sum("gmv").alias("gmv")).orderBy("year")
    )
