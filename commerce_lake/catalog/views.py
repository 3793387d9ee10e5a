"""DuckDB subqueries restating the bindings and the models, for the oracles.

Written separately from the DataFrame code: ranks by row_number, medians by
quantile_cont, durations by date_sub, so that the two can disagree.
"""

MONEY = "DECIMAL(18,2)"
SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def stripped(value: str) -> str:
    """The value without white space at its ends, by pattern."""
    return f"regexp_replace({value}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def _hours(end: str, start: str) -> str:
    return f"date_sub('hour', {start}, {end}) / 24.0::DOUBLE"


VIEWS: dict[str, str] = {
    # Raw tables as bound from the test tables.
    "raw_orders": """
        SELECT 'o' || o_orderkey AS order_id, 'c' || o_orderkey AS customer_id, order_status,
               purchase AS order_purchase_timestamp, approved AS order_approved_at,
               CASE WHEN order_status IN ('delivered', 'shipped')
                    THEN approved + to_days((o_orderkey % 7)::INTEGER) END AS order_delivered_carrier_date,
               CASE WHEN order_status = 'delivered' AND o_orderkey % 83 <> 0
                    THEN purchase
                         + to_days((CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 47 ELSE o_orderkey % 25 END)::INTEGER)
                         + to_hours(o_orderkey % 24) END AS order_delivered_customer_date,
               date_trunc('day', purchase)::TIMESTAMP + INTERVAL 25 DAY AS order_estimated_delivery_date
        FROM (SELECT *, CASE WHEN o_orderkey % 41 = 0 THEN NULL
                             WHEN o_orderkey % 53 = 0 THEN purchase - INTERVAL 1 HOUR
                             ELSE purchase + to_hours(o_orderkey % 50) END AS approved
              FROM (SELECT o_orderkey, o_orderdate::TIMESTAMP + to_minutes(o_orderkey * 37 % 1440) AS purchase,
                           CASE o_orderstatus
                                WHEN 'F' THEN 'delivered'
                                WHEN 'O' THEN CASE o_orderkey % 3 WHEN 0 THEN 'shipped' WHEN 1 THEN 'Invoiced' || chr(9) ELSE 'processing' END
                                ELSE CASE WHEN o_orderkey % 2 = 0 THEN chr(9) || ' canceled' ELSE 'unavailable' END END AS order_status
                    FROM orders))""",
    "raw_customers": """
        SELECT 'c' || o_orderkey || CASE WHEN o_orderkey % 11 = 0 THEN chr(9) ELSE '' END AS customer_id, 'u' || (o_custkey * 8 + o_orderkey % 8) AS customer_unique_id,
               lpad((o_custkey % 400)::VARCHAR, 5, '0') AS customer_zip_code_prefix,
               chr(9) || 'City_' || ((o_custkey + o_orderkey % 2) % (1 + o_custkey % 50)) AS customer_city,
               'nation_' || (o_custkey % 25) AS customer_state
        FROM orders""",
    "line_cents": """
        SELECT *, round(l_extendedprice * 100)::BIGINT AS price_cents,
               (round(l_extendedprice * 100)::BIGINT * round(l_tax * 100)::BIGINT) // 100 AS freight_cents,
               (l_partkey * 64 + l_quantity::BIGINT) * 8 + l_linenumber AS line_id
        FROM lineitem""",
    "raw_order_items": """
        SELECT 'o' || l_orderkey AS order_id, line_id AS order_item_id, 'p' || l_partkey AS product_id,
               's' || l_suppkey AS seller_id, l_shipdate::TIMESTAMP AS shipping_limit_date,
               price_cents / 100.0::DOUBLE AS price, freight_cents / 100.0::DOUBLE AS freight_value
        FROM line_cents""",
    "due_lines": """
        SELECT *, price_cents + freight_cents + CASE WHEN l_orderkey % 97 = 0 THEN 5 ELSE 0 END
                  + CASE WHEN l_orderkey % 89 = 0 AND l_linenumber = 1 THEN 1 ELSE 0 END AS due_cents
        FROM line_cents""",
    "raw_order_payments": """
        SELECT 'o' || l_orderkey AS order_id, line_id * 2 AS payment_sequential,
               CASE l_partkey % 4 WHEN 0 THEN 'Credit_Card' || chr(9) WHEN 1 THEN 'boleto' WHEN 2 THEN 'debit_card' ELSE 'not_defined' END AS payment_type,
               1 + l_suppkey % 26 AS payment_installments,
               (due_cents - CASE WHEN l_partkey % 10 = 0 THEN 500 ELSE 0 END) / 100.0::DOUBLE AS payment_value
        FROM due_lines
        UNION ALL
        SELECT 'o' || l_orderkey, line_id * 2 + 1, 'voucher', 1 + l_suppkey % 26, 5.0::DOUBLE
        FROM due_lines WHERE l_partkey % 10 = 0""",
    "raw_order_reviews": """
        SELECT 'r' || CASE WHEN event_id % 10 = 0 THEN event_id + 1 ELSE event_id END AS review_id,
               'o' || (event_id * 9 // 10) AS order_id, 1 + event_id % 5 AS review_score,
               CASE WHEN event_id % 3 = 0 THEN ' ' || chr(10) || chr(9) ELSE event_type END AS review_comment_title,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END AS review_comment_message,
               ts::TIMESTAMP AS review_creation_date,
               CASE WHEN event_id % 37 = 0 THEN NULL ELSE ts::TIMESTAMP + to_hours(event_id % 90) END AS review_answer_timestamp
        FROM events""",
    "raw_products": """
        SELECT 'p' || p_partkey AS product_id, CASE WHEN p_size = 1 THEN '' ELSE p_type END AS product_category_name,
               length(p_name)::BIGINT AS product_name_lenght, p_size::BIGINT * 10 AS product_description_lenght,
               p_size::BIGINT % 7 AS product_photos_qty, p_size::BIGINT * 100 AS product_weight_g,
               p_size::BIGINT + 5 AS product_length_cm, p_size::BIGINT + 2 AS product_height_cm,
               p_size::BIGINT + 3 AS product_width_cm
        FROM part""",
    "raw_translation": """
        SELECT p_type AS product_category_name,
               CASE p_type WHEN 'ECONOMY' THEN 'AUTO' WHEN 'LARGE' THEN 'ELECTRONICS' WHEN 'MEDIUM' THEN 'BABY'
                           WHEN 'SMALL' THEN 'FOOD' ELSE 'DRINKS' END AS product_category_name_english
        FROM (SELECT DISTINCT p_type FROM part) WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')""",
    "raw_sellers": """
        SELECT 's' || s_suppkey AS seller_id, lpad((s_suppkey % 410)::VARCHAR, 5, '0') AS seller_zip_code_prefix,
               'City_' || (s_suppkey % 30) AS seller_city, 'nation_' || s_nationkey AS seller_state
        FROM supplier""",
    "raw_geolocation": """
        SELECT lpad((c_custkey % 380)::VARCHAR, 5, '0') AS geolocation_zip_code_prefix,
               c_acctbal / 250.0::DOUBLE - 35.0::DOUBLE AS geolocation_lat,
               c_acctbal / 200.0::DOUBLE - 76.0::DOUBLE AS geolocation_lng,
               'City_' || (c_custkey % 50) AS geolocation_city, 'nation_' || c_nationkey AS geolocation_state
        FROM customer""",
    "state_region": "SELECT n_name AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    # Staging.
    "stg_customers": f"""
        SELECT {stripped("customer_id")} AS customer_id, {stripped("customer_unique_id")} AS customer_unique_id,
               {stripped("customer_zip_code_prefix")} AS customer_zip_code_prefix,
               lower({stripped("customer_city")}) AS customer_city, upper({stripped("customer_state")}) AS customer_state
        FROM raw_customers""",
    "stg_orders": f"""SELECT * REPLACE (lower({stripped("order_status")}) AS order_status) FROM raw_orders""",
    "stg_order_items": f"""
        SELECT * REPLACE (price::{MONEY} AS price, freight_value::{MONEY} AS freight_value) FROM raw_order_items""",
    "stg_order_payments": f"""
        SELECT * REPLACE (lower({stripped("payment_type")}) AS payment_type, payment_value::{MONEY} AS payment_value)
        FROM raw_order_payments""",
    "stg_order_reviews": f"""
        SELECT * EXCLUDE (pick) FROM (
          SELECT * REPLACE (nullif({stripped("review_comment_title")}, '') AS review_comment_title,
                            nullif({stripped("review_comment_message")}, '') AS review_comment_message),
                 row_number() OVER (PARTITION BY review_id
                                    ORDER BY review_answer_timestamp DESC NULLS LAST, order_id) AS pick
          FROM raw_order_reviews) WHERE pick = 1""",
    "stg_products": f"""
        SELECT product_id, nullif({stripped("lower(product_category_name)")}, '') AS product_category_name,
               product_name_lenght AS product_name_length, product_description_lenght AS product_description_length,
               product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM raw_products""",
    "stg_sellers": f"""
        SELECT * REPLACE (lower({stripped("seller_city")}) AS seller_city, upper({stripped("seller_state")}) AS seller_state)
        FROM raw_sellers""",
    "stg_geolocation": f"""
        SELECT geolocation_zip_code_prefix, geolocation_lat::DECIMAL(18,9) AS geolocation_lat,
               geolocation_lng::DECIMAL(18,9) AS geolocation_lng,
               lower({stripped("geolocation_city")}) AS geolocation_city, upper({stripped("geolocation_state")}) AS geolocation_state
        FROM raw_geolocation""",
    "stg_translation": f"""
        SELECT lower({stripped("product_category_name")}) AS product_category_name,
               lower({stripped("product_category_name_english")}) AS product_category_name_english
        FROM raw_translation""",
    # Intermediate.
    "zip_points": """
        SELECT geolocation_zip_code_prefix,
               round(quantile_cont(geolocation_lat::DOUBLE, 0.5), 9) AS geolocation_lat,
               round(quantile_cont(geolocation_lng::DOUBLE, 0.5), 9) AS geolocation_lng
        FROM stg_geolocation
        WHERE geolocation_lat BETWEEN -35 AND 6 AND geolocation_lng BETWEEN -75 AND -34
        GROUP BY geolocation_zip_code_prefix""",
    "lifecycle": f"""
        SELECT order_id, customer_unique_id AS customer_key, order_status, order_purchase_timestamp,
               order_purchase_timestamp::DATE AS order_purchase_date, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               {_hours('order_approved_at', 'order_purchase_timestamp')} AS approval_days,
               {_hours('order_delivered_carrier_date', 'order_approved_at')} AS handover_days,
               {_hours('order_delivered_customer_date', 'order_purchase_timestamp')} AS delivery_days,
               {_hours('order_delivered_customer_date', 'order_estimated_delivery_date')} AS estimated_vs_actual_days,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late,
               order_status IN ('delivered', 'shipped', 'invoiced', 'processing') AS is_revenue_order
        FROM stg_orders JOIN stg_customers USING (customer_id)""",
    "order_totals": f"""
        SELECT o.order_id, coalesce(paid, 0)::{MONEY} AS payment_value_total, coalesce(n_paid, 0) AS payment_count,
               coalesce(sold, 0)::{MONEY} AS item_price_total, coalesce(freight, 0)::{MONEY} AS freight_value_total,
               (coalesce(sold, 0) + coalesce(freight, 0))::{MONEY} AS item_gross_total,
               coalesce(n_sold, 0) AS item_count,
               (coalesce(paid, 0) - coalesce(sold, 0) - coalesce(freight, 0))::{MONEY} AS payment_difference,
               abs(coalesce(paid, 0) - coalesce(sold, 0) - coalesce(freight, 0)) <= 0.01 AS is_payment_reconciled
        FROM stg_orders o
        LEFT JOIN (SELECT order_id, sum(payment_value) AS paid, count(*) AS n_paid FROM stg_order_payments GROUP BY 1) p
               ON o.order_id = p.order_id
        LEFT JOIN (SELECT order_id, sum(price) AS sold, sum(freight_value) AS freight, count(*) AS n_sold
                   FROM stg_order_items GROUP BY 1) i ON o.order_id = i.order_id""",
    "history": f"""
        SELECT h.customer_unique_id, a.customer_city, a.customer_state, a.customer_zip_code_prefix,
               first_order_date, last_order_date, order_count, delivered_order_count,
               delivered_order_count > 1 AS is_repeat_customer, lifetime_revenue,
               date_diff('day', last_order_date, DATE '2001-12-31') AS recency_days
        FROM (SELECT customer_unique_id, min(order_purchase_timestamp::DATE) AS first_order_date,
                     max(order_purchase_timestamp::DATE) AS last_order_date, count(*) AS order_count,
                     count(*) FILTER (order_status = 'delivered') AS delivered_order_count,
                     coalesce(sum(payment_value_total) FILTER (
                        order_status IN ('delivered', 'shipped', 'invoiced', 'processing')), 0)::{MONEY} AS lifetime_revenue
              FROM stg_customers JOIN stg_orders USING (customer_id) JOIN order_totals USING (order_id)
              GROUP BY 1) h
        JOIN (SELECT c.*, row_number() OVER (PARTITION BY customer_unique_id
                                             ORDER BY order_purchase_timestamp DESC, order_id DESC) AS pick
              FROM stg_customers c JOIN stg_orders USING (customer_id)) a
          ON a.customer_unique_id = h.customer_unique_id AND a.pick = 1""",
    # Marts.
    "dim_customer": """
        SELECT customer_unique_id AS customer_key, customer_city, customer_state, customer_zip_code_prefix,
               geolocation_lat AS customer_latitude, geolocation_lng AS customer_longitude,
               first_order_date, last_order_date, order_count, delivered_order_count, is_repeat_customer,
               lifetime_revenue, recency_days
        FROM history LEFT JOIN zip_points ON customer_zip_code_prefix = geolocation_zip_code_prefix""",
    "day_bounds": """
        SELECT make_date(year(min(o_orderdate))::INTEGER, 1, 1) AS a,
               make_date(year(max(o_orderdate))::INTEGER, 12, 31) AS b FROM orders""",
    "dim_date": """
        SELECT d AS date_key, year(d)::INTEGER AS year_number, quarter(d)::INTEGER AS quarter_number,
               year(d) || '-Q' || quarter(d) AS year_quarter, month(d)::INTEGER AS month_number,
               strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
               weekofyear(d)::INTEGER AS iso_week_number, (dayofweek(d) + 1)::INTEGER AS day_of_week_number,
               strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
               d = last_day(d) AS is_month_end, d <= DATE '2001-07-31' AS is_complete_month
        FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS d FROM day_bounds)""",
    "dim_product": """
        SELECT product_id AS product_key, coalesce(p.product_category_name, 'unknown') AS product_category_name,
               coalesce(product_category_name_english, 'unknown') AS product_category_name_english,
               product_name_length, product_description_length, product_photos_qty, product_weight_g,
               product_length_cm, product_height_cm, product_width_cm
        FROM stg_products p LEFT JOIN stg_translation t ON p.product_category_name = t.product_category_name""",
    "dim_seller": """
        SELECT seller_id AS seller_key, seller_city, seller_state, seller_zip_code_prefix,
               geolocation_lat AS seller_latitude, geolocation_lng AS seller_longitude
        FROM stg_sellers LEFT JOIN zip_points ON seller_zip_code_prefix = geolocation_zip_code_prefix""",
    "fct_order_items": """
        SELECT order_id, order_item_id, customer_key, product_id AS product_key, seller_id AS seller_key,
               order_purchase_date, order_status, shipping_limit_date::DATE AS shipping_limit_date,
               price, freight_value, price + freight_value AS line_gross_value
        FROM stg_order_items JOIN lifecycle USING (order_id)""",
    "fct_orders": """
        SELECT order_id, customer_key, order_purchase_date, order_purchase_timestamp, order_status,
               order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
               order_estimated_delivery_date, approval_days, handover_days, delivery_days,
               estimated_vs_actual_days, is_late, is_revenue_order, item_count, payment_count,
               item_price_total, freight_value_total, item_gross_total, payment_value_total,
               payment_difference, is_payment_reconciled
        FROM lifecycle JOIN order_totals USING (order_id)""",
    "fct_payments": """
        SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
        FROM stg_order_payments""",
    "fct_reviews": f"""
        SELECT review_id, order_id, review_score, review_creation_date::DATE AS review_creation_date,
               review_creation_date AS review_creation_timestamp, review_answer_timestamp,
               {_hours('review_answer_timestamp', 'review_creation_date')} AS review_response_days,
               review_comment_title, review_comment_message,
               coalesce(review_comment_title, review_comment_message) IS NOT NULL AS has_comment
        FROM stg_order_reviews""",
    # Location models, over the raw tables.
    "geo_zip": """
        SELECT geolocation_zip_code_prefix AS zip_code_prefix,
               sum(geolocation_lat::DECIMAL(18,9))::DOUBLE / count(*) AS latitude,
               sum(geolocation_lng::DECIMAL(18,9))::DOUBLE / count(*) AS longitude,
               min(geolocation_city) AS city, min(geolocation_state) AS state
        FROM raw_geolocation GROUP BY 1""",
    "geo_product": """
        SELECT product_id, coalesce(product_category_name_english, 'unknown') AS product_category_name_english,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM raw_products p LEFT JOIN raw_translation t ON p.product_category_name = t.product_category_name""",
    "geo_sales": f"""
        SELECT o.order_id, o.customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
               upper(customer_state) AS customer_state, latitude, longitude,
               sum(payment_value::{MONEY}) AS total_order_revenue, order_purchase_timestamp
        FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
        JOIN raw_order_payments p ON p.order_id = o.order_id
        LEFT JOIN geo_zip ON customer_zip_code_prefix = zip_code_prefix
        WHERE order_status = 'delivered'
        GROUP BY ALL""",
    "geo_seller_sales": f"""
        SELECT product_category_name_english, i.seller_id, i.order_id, seller_city AS city,
               upper(seller_state) AS state, latitude, longitude,
               sum(price::{MONEY} + freight_value::{MONEY}) AS total_revenue
        FROM raw_order_items i JOIN raw_orders o ON i.order_id = o.order_id
        JOIN geo_product g ON g.product_id = i.product_id
        JOIN raw_sellers s ON s.seller_id = i.seller_id
        LEFT JOIN geo_zip ON seller_zip_code_prefix = zip_code_prefix
        WHERE order_status = 'delivered'
        GROUP BY ALL""",
    "geo_places": """
        SELECT customer_city AS city, customer_state AS state, sum(latitude::DECIMAL(18,9))::DOUBLE / count(*) AS latitude,
               sum(longitude::DECIMAL(18,9))::DOUBLE / count(*) AS longitude, count(DISTINCT order_id) AS total_orders,
               sum(total_order_revenue) AS total_revenue_Brazilian_Real
        FROM geo_sales WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2""",
    "geo_seller_places": """
        SELECT seller_id, product_category_name_english, city, state, sum(latitude::DECIMAL(18,9))::DOUBLE / count(*) AS latitude,
               sum(longitude::DECIMAL(18,9))::DOUBLE / count(*) AS longitude, count(DISTINCT order_id) AS total_orders,
               sum(total_revenue) AS total_revenue_Brazilian_Real
        FROM geo_seller_sales WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3, 4""",
}
