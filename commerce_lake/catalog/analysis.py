"""A0-A4: the analyses, with oracles over the restated marts."""

from __future__ import annotations

from commerce_lake.catalog.common import Query, over_models, with_views
from commerce_lake.catalog.views import VIEWS
from commerce_lake.plans import analytics

_LATE_BUCKET = """
    CASE WHEN NOT is_late THEN '0  on time / early'
         WHEN days_late <= 3 THEN '1  1-3 days late'
         WHEN days_late <= 7 THEN '2  4-7 days late'
         WHEN days_late <= 15 THEN '3  8-15 days late'
         ELSE '4  16+ days late' END"""

ANALYSIS_VIEWS = {
    **VIEWS,
    "revenue_orders": "SELECT * FROM fct_orders WHERE is_revenue_order",
    "plausible_orders": "SELECT * FROM fct_orders WHERE delivery_days BETWEEN 0 AND 180",
    "arrived": f"""
        SELECT *, {_LATE_BUCKET} AS delivery_bucket
        FROM (SELECT *, date_diff('day', order_estimated_delivery_date::DATE, order_delivered_customer_date::DATE) AS days_late
              FROM revenue_orders WHERE is_late IS NOT NULL)""",
    "placed": """
        SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY order_purchase_timestamp, order_id) AS nth
        FROM fct_orders""",
    "cohort": "SELECT * FROM placed WHERE nth = 1 AND order_purchase_date <= DATE '2000-06-30'",
    "late_months": """
        SELECT year_month, count(*) AS delivered_orders,
               round(100.0::DOUBLE * count(*) FILTER (is_late) / count(*), 1) AS late_rate_pct
        FROM arrived JOIN dim_date ON date_key = order_purchase_date
        WHERE is_complete_month AND date_key >= DATE '1995-02-01' GROUP BY 1""",
    "segments": """
        SELECT segment, count(*) AS customers,
               round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct_customers,
               round(sum(lifetime_revenue)::DOUBLE) AS revenue,
               round(100.0::DOUBLE * (sum(lifetime_revenue)::DOUBLE / sum(sum(lifetime_revenue)) OVER ()::DOUBLE), 2) AS pct_revenue,
               round(sum(lifetime_revenue)::DOUBLE / count(*), 2) AS avg_lifetime_revenue
        FROM (SELECT *, CASE WHEN order_count >= 4 THEN '4+ orders' WHEN order_count = 1 THEN '1 order'
                             ELSE order_count || ' orders' END AS segment FROM dim_customer)
        GROUP BY 1""",
    "gaps": """
        SELECT date_diff('day', a.order_purchase_date, b.order_purchase_date) AS gap_days
        FROM placed a JOIN placed b ON a.customer_key = b.customer_key AND a.nth = 1 AND b.nth = 2""",
    "category_rates": """
        SELECT category, count(*) AS customers,
               round(100.0::DOUBLE * count(*) FILTER (order_count > 1) / count(*), 2) AS repeat_rate_pct
        FROM cohort
        JOIN (SELECT order_id, product_category_name_english AS category,
                     row_number() OVER (PARTITION BY order_id ORDER BY price DESC, order_item_id) AS pick
              FROM fct_order_items JOIN dim_product USING (product_key)) l
          ON l.order_id = cohort.order_id AND l.pick = 1
        JOIN dim_customer c ON c.customer_key = cohort.customer_key
        GROUP BY 1 HAVING count(*) >= 250""",
    "state_values": """
        SELECT customer_state AS state, count(*) AS customers,
               round(100.0::DOUBLE * count(*) FILTER (order_count > 1) / count(*), 2) AS repeat_rate_pct,
               round(sum(lifetime_revenue)::DOUBLE / count(*), 2) AS avg_lifetime_revenue
        FROM dim_customer GROUP BY 1 HAVING count(*) >= 300""",
    "state_sales": """
        SELECT customer_state AS state, count(*) AS orders, count(DISTINCT o.customer_key) AS customers,
               round(sum(item_price_total)::DOUBLE) AS revenue,
               round(100.0::DOUBLE * (sum(item_price_total)::DOUBLE / sum(sum(item_price_total)) OVER ()::DOUBLE), 2) AS pct_revenue,
               round(sum(item_price_total)::DOUBLE / count(*), 2) AS avg_order_value
        FROM revenue_orders o JOIN dim_customer USING (customer_key) GROUP BY 1""",
    "region_sales": """
        SELECT region, orders, customers, revenue, pct_revenue,
               round(sum(pct_revenue::DECIMAL(18,2)) OVER (ORDER BY revenue DESC, region), 1)::DOUBLE AS cum_pct_revenue,
               round(revenue / orders, 2) AS avg_order_value
        FROM (SELECT region, sum(orders)::BIGINT AS orders, sum(customers)::BIGINT AS customers, sum(revenue) AS revenue,
                     round(100.0::DOUBLE * (sum(revenue) / sum(sum(revenue)) OVER ()), 2) AS pct_revenue
              FROM state_sales JOIN state_region USING (state) GROUP BY region)""",
    "city_sales": """
        SELECT customer_city || ' / ' || customer_state AS city, customer_city, customer_state,
               count(*) AS orders, count(DISTINCT o.customer_key) AS customers, sum(item_price_total) AS revenue
        FROM revenue_orders o JOIN dim_customer USING (customer_key) GROUP BY 1, 2, 3""",
    "city_ranks": """
        SELECT *, row_number() OVER (ORDER BY revenue DESC, city) AS pos,
               sum(revenue) OVER () AS total FROM city_sales""",
    "located": """
        SELECT * FROM dim_customer
        WHERE customer_city IS NOT NULL AND customer_latitude IS NOT NULL AND customer_longitude IS NOT NULL""",
    "city_leaders": """
        SELECT c.customer_city AS name, sum(customer_latitude::DECIMAL(18,9))::DOUBLE / count(*) AS latitude,
               sum(customer_longitude::DECIMAL(18,9))::DOUBLE / count(*) AS longitude, count(*) AS customer_count,
               sum(lifetime_revenue)::DOUBLE AS total_lifetime_revenue, any_value(top_key) AS top_customer_key,
               any_value(top_revenue)::DOUBLE AS top_customer_lifetime_revenue
        FROM located c
        JOIN (SELECT customer_city, customer_key AS top_key, lifetime_revenue AS top_revenue,
                     row_number() OVER (PARTITION BY customer_city ORDER BY lifetime_revenue DESC, customer_key) AS pick
              FROM located) t ON t.customer_city = c.customer_city AND t.pick = 1
        GROUP BY 1 ORDER BY total_lifetime_revenue DESC, name LIMIT 10""",
    "on_time_lines": """
        SELECT year(order_purchase_timestamp)::INTEGER AS year, price
        FROM raw_orders o JOIN raw_order_items i ON o.order_id = i.order_id
        JOIN raw_products p ON p.product_id = i.product_id
        WHERE order_delivered_customer_date <= order_estimated_delivery_date""",
    "measured": """
        SELECT 'order product value (R$)' AS measure, item_price_total::DOUBLE AS v FROM revenue_orders
        UNION ALL SELECT 'freight per order (R$)', freight_value_total::DOUBLE FROM revenue_orders
        UNION ALL SELECT 'items per order', item_count::DOUBLE FROM revenue_orders
        UNION ALL SELECT 'delivery days (capped 0-180)', delivery_days FROM plausible_orders
        UNION ALL SELECT 'review score (1-5)', review_score::DOUBLE FROM fct_reviews
        UNION ALL SELECT 'lifetime revenue per customer (R$)', lifetime_revenue::DOUBLE FROM dim_customer""",
}


def _top_share(n: int) -> str:
    return f"round(100.0::DOUBLE * (sum(revenue) FILTER (pos <= {n})::DOUBLE / sum(revenue)::DOUBLE), 1) AS top_{n}_pct"


_CUSTOMER = "(SELECT {} FROM dim_customer)"
_HEADLINE = """
SELECT (SELECT count(*) FROM fct_orders) AS orders_total,
  (SELECT count(*) FROM fct_order_items) AS order_lines_total,
  (SELECT count(*) FROM dim_customer) AS customers_total,
  (SELECT count(DISTINCT seller_key) FROM fct_order_items) AS sellers_with_sales,
  (SELECT count(DISTINCT product_key) FROM fct_order_items) AS products_with_sales,
  (SELECT count(DISTINCT customer_state) FROM dim_customer) AS customer_states,
  (SELECT count(DISTINCT customer_city || '/' || customer_state) FROM dim_customer) AS customer_city_values,
  (SELECT min(order_purchase_date) FROM fct_orders) AS first_order_date,
  (SELECT max(order_purchase_date) FROM fct_orders) AS last_order_date,
  r.*, p.*, c.*, o.*, v.*,
  (SELECT round(avg(delivery_days), 1) FROM plausible_orders) AS avg_delivery_days,
  (SELECT round(quantile_cont(delivery_days, 0.5), 1) FROM plausible_orders) AS median_delivery_days,
  (SELECT round(100.0::DOUBLE * count(DISTINCT order_id) / (SELECT count(*) FROM fct_orders), 1) FROM fct_reviews) AS pct_orders_with_review
FROM (SELECT round(sum(item_price_total)::DOUBLE) AS product_revenue_brl, round(sum(freight_value_total)::DOUBLE) AS freight_brl,
             round(sum(item_gross_total)::DOUBLE) AS gmv_incl_freight_brl, count(*) AS revenue_orders,
             round(sum(item_price_total)::DOUBLE / count(*), 2) AS avg_order_value_brl,
             round(sum(item_count)::DOUBLE / count(*), 2) AS avg_items_per_order FROM revenue_orders) r,
     (SELECT round(sum(payment_value)::DOUBLE) AS payments_received_brl,
             round(sum(payment_installments)::DOUBLE / count(*), 2) AS avg_installments,
             round(100.0::DOUBLE * count(*) FILTER (payment_installments > 1) / count(*), 1) AS pct_paid_in_installments
      FROM fct_payments) p,
     (SELECT round(100.0::DOUBLE * count(*) FILTER (order_count > 1) / count(*), 2) AS repeat_rate_placed_pct,
             round(100.0::DOUBLE * count(*) FILTER (delivered_order_count > 1) / count(*), 2) AS repeat_rate_delivered_pct,
             round(sum(order_count)::DOUBLE / count(*), 3) AS avg_orders_per_customer,
             round(sum(lifetime_revenue)::DOUBLE / count(*), 2) AS avg_lifetime_revenue_brl,
             round(quantile_disc(lifetime_revenue::DOUBLE, 0.5), 2) AS median_lifetime_revenue_brl FROM dim_customer) c,
     (SELECT round(100.0::DOUBLE * count(*) FILTER (is_revenue_order) / count(*), 1) AS revenue_orders_pct,
             round(100.0::DOUBLE * count(order_delivered_customer_date) / count(*), 1) AS pct_orders_delivered,
             round(100.0::DOUBLE * count(*) FILTER (is_late) / count(is_late), 1) AS late_rate_of_delivered_pct,
             round(avg(date_diff('day', order_estimated_delivery_date::DATE, order_delivered_customer_date::DATE))
                   FILTER (is_late IS NOT NULL), 1) AS avg_days_late_vs_promise FROM fct_orders) o,
     (SELECT round(avg(review_score), 2) AS avg_review_score,
             round(100.0::DOUBLE * count(*) FILTER (review_score = 5) / count(*), 1) AS pct_5_star,
             round(100.0::DOUBLE * count(*) FILTER (review_score <= 2) / count(*), 1) AS pct_1_2_star,
             round(avg(review_response_days), 1) AS avg_review_response_days FROM fct_reviews) v"""

_POINTS = ", ".join(
    f"round(quantile_disc(v, {p}), 2) AS {name}" for name, p in analytics.PROFILE_POINTS.items()
)

_ANALYSES = {
    "A0.1_headline_metrics": (analytics.headline_metrics, _HEADLINE),
    "A0.2_percentile_profile": (
        analytics.percentile_profile, f"SELECT measure, {_POINTS} FROM measured GROUP BY measure"),
    "A0.3_review_score_distribution": (
        analytics.review_score_distribution,
        """SELECT review_score, count(*) AS reviews,
                  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM fct_reviews GROUP BY 1"""),
    "A0.4_order_status_funnel": (
        analytics.order_status_funnel,
        """SELECT order_status, count(*) AS orders,
                  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct_orders,
                  round(sum(item_price_total)::DOUBLE) AS product_revenue FROM fct_orders GROUP BY 1"""),
    "A0.5_monthly_revenue": (
        analytics.monthly_revenue,
        """SELECT year_month, is_complete_month, count(*) AS orders, round(sum(item_price_total)::DOUBLE) AS product_revenue
           FROM revenue_orders JOIN dim_date ON date_key = order_purchase_date
           WHERE year_month >= '1995-02' GROUP BY 1, 2"""),
    "A0.6_payment_mix": (
        analytics.payment_mix,
        """SELECT payment_type, count(*) AS payments,
                  round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct_of_payments,
                  round(sum(payment_value)::DOUBLE) AS total_value,
                  round(sum(payment_installments)::DOUBLE / count(*), 1) AS avg_installments
           FROM fct_payments GROUP BY 1"""),
    "A1.1_reviews_by_lateness": (
        analytics.reviews_by_lateness,
        """SELECT delivery_bucket, count(*) AS orders, round(sum(review_score)::DOUBLE / count(*), 2) AS avg_review_score,
                  round(100.0::DOUBLE * count(*) FILTER (review_score <= 2) / count(*), 1) AS dissatisfied_rate_pct,
                  round(100.0::DOUBLE * count(*) FILTER (review_score = 5) / count(*), 1) AS five_star_pct
           FROM arrived JOIN fct_reviews USING (order_id) GROUP BY 1"""),
    "A1.2_value_by_first_experience": (
        analytics.value_by_first_experience,
        """SELECT CASE WHEN is_late THEN 'first order LATE' WHEN NOT is_late THEN 'first order on time'
                       ELSE 'undelivered first order' END AS first_experience, count(*) AS customers,
                  round(100.0::DOUBLE * count(*) FILTER (order_count > 1) / count(*), 2) AS repeat_rate_pct,
                  round(sum(lifetime_revenue)::DOUBLE / count(*), 2) AS avg_lifetime_revenue
           FROM cohort LEFT JOIN dim_customer USING (customer_key) GROUP BY 1"""),
    "A1.3_late_rate_by_month": (analytics.late_rate_by_month, "SELECT * FROM late_months"),
    "A1.3b_worst_late_months": (
        analytics.worst_late_months, "SELECT * FROM late_months WHERE late_rate_pct >= 10"),
    "A1.4_revenue_through_late_delivery": (
        analytics.revenue_through_late_delivery,
        """SELECT count(*) AS delivered_revenue_orders,
                  round(100.0::DOUBLE * count(*) FILTER (is_late) / count(*), 2) AS late_order_rate_pct,
                  round(sum(item_price_total)::DOUBLE) AS product_revenue,
                  round((sum(item_price_total) FILTER (is_late))::DOUBLE) AS revenue_via_late_delivery,
                  round(100.0::DOUBLE * ((sum(item_price_total) FILTER (is_late))::DOUBLE / sum(item_price_total)::DOUBLE), 2) AS pct_revenue_via_late
           FROM arrived"""),
    "A1.5_revenue_by_lateness": (
        analytics.revenue_by_lateness,
        """SELECT delivery_bucket, count(*) AS orders, round(sum(item_price_total)::DOUBLE) AS revenue,
                  round(100.0::DOUBLE * (sum(item_price_total)::DOUBLE / sum(sum(item_price_total)) OVER ()::DOUBLE), 2) AS pct_revenue
           FROM arrived GROUP BY 1"""),
    "A2.1_order_count_segments": (analytics.order_count_segments, "SELECT * FROM segments"),
    "A2.2_second_order_timing": (
        analytics.second_order_timing,
        """SELECT count(*) AS repeat_customers, quantile_cont(gap_days::DOUBLE, 0.25) AS p25_gap_days,
                  quantile_cont(gap_days::DOUBLE, 0.5) AS median_gap_days, quantile_cont(gap_days::DOUBLE, 0.75) AS p75_gap_days,
                  round(100.0::DOUBLE * count(*) FILTER (gap_days <= 30) / count(*), 1) AS within_30_days_pct,
                  round(100.0::DOUBLE * count(*) FILTER (gap_days <= 60) / count(*), 1) AS within_60_days_pct,
                  round(100.0::DOUBLE * count(*) FILTER (gap_days <= 90) / count(*), 1) AS within_90_days_pct
           FROM gaps"""),
    "A2.2b_second_order_histogram": (
        analytics.second_order_histogram,
        """SELECT bin::INTEGER AS bin, count(*) AS customers, min(g)::INTEGER AS min_gap_days, max(g)::INTEGER AS max_gap_days
           FROM (SELECT g, least((g - lo) * 37 // (hi - lo) + 1, 37) AS bin
                 FROM (SELECT least(gap_days, 365) AS g, min(least(gap_days, 365)) OVER () AS lo,
                              max(least(gap_days, 365)) OVER () AS hi FROM gaps))
           GROUP BY 1"""),
    "A2.3_repeat_rate_by_first_category": (
        analytics.repeat_rate_by_first_category, "SELECT * FROM category_rates"),
    "A2.3b_best_and_worst_categories": (
        analytics.best_and_worst_categories,
        """(SELECT 'best' AS side, * FROM category_rates ORDER BY repeat_rate_pct DESC, category LIMIT 6)
           UNION ALL (SELECT 'worst', * FROM category_rates ORDER BY repeat_rate_pct, category DESC LIMIT 6)"""),
    "A2.4_value_by_state": (analytics.value_by_state, "SELECT * FROM state_values"),
    "A2.4b_state_rate_range": (
        analytics.state_rate_range,
        "SELECT min(repeat_rate_pct) AS lowest_pct, max(repeat_rate_pct) AS highest_pct FROM state_values"),
    "A2.5_recency_buckets": (
        analytics.recency_buckets,
        """SELECT CASE WHEN recency_days > 540 THEN '540+ days' WHEN recency_days > 365 THEN '366-540 days'
                       WHEN recency_days > 180 THEN '181-365 days' ELSE '0-180 days' END AS time_since_last_order,
                  count(*) AS customers,
                  round(100.0::DOUBLE * count(*) FILTER (order_count > 1) / count(*), 2) AS repeat_rate_pct,
                  round(sum(lifetime_revenue)::DOUBLE) AS revenue_to_date
           FROM dim_customer GROUP BY 1"""),
    "A2.6_repeat_rate_what_if": (
        analytics.repeat_rate_what_if,
        """SELECT target, round(100.0::DOUBLE * again / n, 1) AS repeat_rate_now_pct, round(step, 2) AS incremental_value,
                  round(n * (target - again::DOUBLE / n)) AS extra_repeat_customers,
                  round(n * (target - again::DOUBLE / n) * step) AS extra_revenue
           FROM (SELECT sum(customers) AS n, sum(customers) FILTER (segment <> '1 order') AS again,
                        max(avg_lifetime_revenue) FILTER (segment = '2 orders')
                        - max(avg_lifetime_revenue) FILTER (segment = '1 order') AS step FROM segments),
                (SELECT unnest([0.04::DOUBLE, 0.05::DOUBLE, 0.06::DOUBLE]) AS target)"""),
    "A3.1_revenue_by_state": (
        analytics.revenue_by_state,
        """SELECT state, region, orders, customers, revenue, pct_revenue, avg_order_value,
                  round(sum(pct_revenue::DECIMAL(18,2)) OVER (ORDER BY revenue DESC, state), 1)::DOUBLE AS cum_pct_revenue
           FROM state_sales LEFT JOIN state_region USING (state)"""),
    "A3.1b_revenue_by_region": (analytics.revenue_by_region, "SELECT * FROM region_sales"),
    "A3.1c_region_volume_and_value": (
        analytics.region_volume_and_value, "SELECT region, orders, avg_order_value FROM region_sales"),
    "A3.2_top_cities": (
        analytics.top_cities,
        """SELECT city, region, orders, customers, shown AS revenue, pct_revenue,
                  round(sum(pct_revenue::DECIMAL(18,2)) OVER (ORDER BY shown DESC, city), 1)::DOUBLE AS cum_pct_revenue, customer_city AS city_label
           FROM (SELECT *, round(revenue::DOUBLE) AS shown,
                        round(100.0::DOUBLE * (revenue::DOUBLE / total::DOUBLE), 2) AS pct_revenue
                 FROM city_ranks ORDER BY shown DESC, city LIMIT 20)
           LEFT JOIN state_region ON state = customer_state"""),
    "A3.3_revenue_concentration": (
        analytics.revenue_concentration,
        f"""SELECT {', '.join(_top_share(n) for n in (1, 5, 10, 25, 50, 100))}, count(*) AS city_values,
                   count(*) FILTER (orders = 1) AS one_order_cities, count(*) FILTER (orders <= 5) AS tail_cities,
                   coalesce(round(100.0::DOUBLE * ((sum(revenue) FILTER (orders <= 5))::DOUBLE / sum(revenue)::DOUBLE), 1), 0) AS tail_revenue_pct
            FROM city_ranks"""),
    "W7b_running_share_of_all_cities": (
        analytics.running_city_share,
        """SELECT city, orders, round(revenue::DOUBLE) AS revenue,
                  round(100.0::DOUBLE * ((sum(revenue) OVER (ORDER BY revenue DESC, city))::DOUBLE / total::DOUBLE), 2) AS cum_pct_revenue,
                  (sum(orders) OVER (ORDER BY revenue DESC, city))::BIGINT AS orders_so_far
           FROM city_ranks"""),
    "A3.4_city_tiers": (
        analytics.city_tiers,
        """SELECT tier, n AS n_cities, round(100.0::DOUBLE * (coalesce(r, 0)::DOUBLE / total::DOUBLE), 1) AS revenue_pct,
                  round(100.0::DOUBLE * n / cities, 1) AS cities_pct
           FROM (SELECT 'Top 20 cities' AS tier, count(*) FILTER (pos <= 20) AS n, sum(revenue) FILTER (pos <= 20) AS r,
                        count(*) AS cities, sum(revenue) AS total FROM city_ranks
                 UNION ALL
                 SELECT 'Mid-tier cities (>5 orders)', count(*) FILTER (pos > 20 AND orders > 5),
                        sum(revenue) FILTER (pos > 20 AND orders > 5), count(*), sum(revenue) FROM city_ranks
                 UNION ALL
                 SELECT 'Long tail (≤5 orders)', count(*) FILTER (orders <= 5), sum(revenue) FILTER (orders <= 5),
                        count(*), sum(revenue) FROM city_ranks)"""),
    "A4.1_cities_with_top_customer": (
        analytics.cities_with_top_customer, "SELECT * FROM city_leaders"),
    "A4.2_revenue_by_category_and_city": (
        analytics.revenue_by_category_and_city,
        """SELECT customer_city, product_category_name_english, sum(line_gross_value)::DOUBLE AS life_revenue
           FROM fct_order_items JOIN dim_customer USING (customer_key) JOIN dim_product USING (product_key)
           WHERE product_category_name_english IN ('auto', 'electronics', 'drinks', 'food', 'baby')
           GROUP BY 1, 2 ORDER BY life_revenue DESC, customer_city, product_category_name_english"""),
    "A4.3_yearly_gmv": (
        analytics.yearly_gmv,
        "SELECT year, sum(price::DECIMAL(18,2))::DOUBLE AS gmv FROM on_time_lines GROUP BY 1"),
    "G24_mean_monthly_late_rate": (
        analytics.mean_monthly_late_rate,
        "SELECT round(avg(late_rate_pct), 1) AS mean_late_rate_pct FROM late_months"),
    "F17_mean_review_score": (
        analytics.mean_review_score, "SELECT round(avg(review_score), 2) AS avg_score FROM fct_reviews"),
}

QUERIES: dict[str, Query] = {name: over_models(build) for name, (build, _) in _ANALYSES.items()}
ORACLES: dict[str, str] = {name: with_views(ANALYSIS_VIEWS, sql) for name, (_, sql) in _ANALYSES.items()}
