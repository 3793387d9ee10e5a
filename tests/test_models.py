from datetime import date
from decimal import Decimal

from conftest import rows_by
from pyspark.sql import functions as F

from commerce_lake.plans import history
from commerce_lake.plans.models import Models
from commerce_lake.sources.storage import Lake


def test_staging_cleans_text_and_keeps_codes(models):
    customers = rows_by(models.stg_customers, "customer_id")
    assert customers["c4"].customer_unique_id == "B"
    assert (customers["c1"].customer_city, customers["c1"].customer_state) == ("rio", "RJ")
    assert customers["c1"].customer_zip_code_prefix == "01234"
    assert rows_by(models.stg_orders, "order_id")["o2"].order_status == "delivered"
    assert rows_by(models.stg_products, "product_id")["p3"].product_category_name is None


def test_reviews_keep_latest_answer_then_lowest_order(models):
    reviews = rows_by(models.stg_order_reviews, "review_id")
    assert {k: r.order_id for k, r in reviews.items()} == {"r1": "o1", "r2": "o2", "r3": "o6", "r4": "o4"}
    assert reviews["r1"].review_comment_title is None
    assert reviews["r2"].review_comment_message is None


def test_lifecycle_durations_and_late_flag(models):
    orders = rows_by(models.int_order_lifecycle, "order_id")
    assert orders["o1"].approval_days == 1 / 24.0
    assert orders["o1"].delivery_days == 96 / 24.0
    assert orders["o4"].approval_days == -3 / 24.0
    assert {k: o.is_late for k, o in orders.items()} == {
        "o1": False, "o2": True, "o3": False, "o4": False, "o5": None, "o6": True, "o7": None, "o8": None,
    }
    assert [k for k, o in sorted(orders.items()) if not o.is_revenue_order] == ["o5"]


def test_totals_do_not_fan_out_and_tolerate_one_cent(models):
    totals = rows_by(models.int_order_payment_totals, "order_id")
    assert totals["o1"].payment_value_total == Decimal("110.00")
    assert (totals["o4"].item_count, totals["o4"].item_gross_total) == (3, Decimal("55.00"))
    assert totals["o2"].payment_difference == Decimal("-0.01") and totals["o2"].is_payment_reconciled
    assert totals["o3"].payment_difference == Decimal("0.02") and not totals["o3"].is_payment_reconciled
    assert (totals["o5"].item_count, totals["o5"].payment_value_total) == (0, Decimal("0.00"))
    assert totals["o5"].is_payment_reconciled


def test_history_takes_one_whole_address_from_the_last_order(models):
    history = rows_by(models.int_customer_order_history, "customer_unique_id")
    a, d = history["A"], history["D"]
    assert (a.customer_city, a.customer_state, a.customer_zip_code_prefix) == ("santos", "SP", "99999")
    assert (d.customer_city, d.customer_state, d.customer_zip_code_prefix) == ("natal", "RN", "77777")
    assert (a.order_count, a.delivered_order_count, a.is_repeat_customer) == (3, 2, True)
    assert a.lifetime_revenue == Decimal("275.01")
    assert history["C"].lifetime_revenue == Decimal("0.00")
    assert (a.first_order_date, a.last_order_date) == (date(2017, 1, 1), date(2017, 6, 1))
    assert a.recency_days == (date(2018, 12, 31) - date(2017, 6, 1)).days


def test_median_point_per_zip_ignores_points_outside(models):
    points = rows_by(models.int_geolocation_deduped, "geolocation_zip_code_prefix")
    assert set(points) == {"01234", "55555"}
    assert (points["01234"].geolocation_lat, points["01234"].geolocation_lng) == (-23.0, -44.0)
    assert (points["55555"].geolocation_lat, points["55555"].geolocation_lng) == (-5.5, -35.5)


def test_dimensions(models):
    products = rows_by(models.dim_product, "product_key")
    assert products["p3"].product_category_name == "unknown"
    # An untranslated category keeps its own name.
    assert products["p4"].product_category_name == "pc_gamer"
    assert products["p4"].product_category_name_english == "unknown"
    assert products["p2"].product_category_name_english == "furniture"
    sellers = rows_by(models.dim_seller, "seller_key")
    assert sellers["s1"].seller_latitude == -23.0 and sellers["s2"].seller_latitude is None
    days = rows_by(models.dim_date, "date_key")
    assert len(days) == 852
    sunday = days[date(2018, 9, 30)]
    assert (sunday.day_of_week_number, sunday.is_weekend, sunday.is_month_end) == (1, True, True)
    assert (sunday.year_quarter, sunday.year_month, sunday.month_name) == ("2018-Q3", "2018-09", "September")
    assert not sunday.is_complete_month and days[date(2018, 8, 31)].is_complete_month


def test_facts_keep_their_grain(models):
    assert models.fct_orders.count() == 8
    assert models.fct_order_items.count() == 10
    assert models.fct_payments.count() == 8
    reviews = rows_by(models.fct_reviews, "review_id")
    assert reviews["r1"].review_response_days == 36 / 24.0
    assert reviews["r4"].review_response_days is None
    assert {k: r.has_comment for k, r in reviews.items()} == {"r1": True, "r2": True, "r3": True, "r4": False}
    line = models.fct_order_items.where("order_id = 'o2' and order_item_id = 2").first()
    assert line.line_gross_value == Decimal("77.00") and line.customer_key == "A"


def test_stored_totals_give_the_same_facts(models, raw, params):
    from commerce_lake.plans.models import Models

    stored = Models(raw, params, stored={"int_order_payment_totals": models.int_order_payment_totals})
    assert sorted(stored.fct_orders.collect()) == sorted(models.fct_orders.collect())
    assert sorted(stored.int_customer_order_history.collect()) == sorted(
        models.int_customer_order_history.collect()
    )


def test_location_models(models):
    places = {(r.city, r.state): r for r in models.mart_revenue_by_location.collect()}
    # Only exactly 'delivered' raw orders count here; o2 is padded and mixed case.
    assert (" Rio ", "RJ") in places and places[(" Rio ", "RJ")].total_orders == 1
    assert places[(" Rio ", "RJ")].total_revenue_Brazilian_Real == Decimal("110.00")
    sellers = models.mart_seller_by_location.collect()
    assert [r.seller_id for r in sellers] == ["s1", "s1"]
    assert sellers[0].total_revenue_Brazilian_Real == Decimal("200.00")


def test_histories_fold_forward(spark, raw, params, tmp_path):
    lake = Lake(str(tmp_path), "ci")
    m = Models(raw, params)
    rows = lambda df: sorted(map(str, df.select(*m.int_customer_order_history.columns).collect()))
    assert rows(history.store(m, lake)) == rows(m.int_customer_order_history)
    # One order is cancelled, one disappears.
    month = history.month_of(F.col("order_purchase_timestamp")).cast("string").alias("month")
    every = [r.month for r in m.stg_orders.select(month).distinct().collect()]
    touched = [r.month for r in m.stg_orders.where("order_id IN ('o1', 'o2')").select(month).distinct().collect()]
    changed = dict(raw)
    changed["orders"] = raw["orders"].where("order_id <> 'o1'").withColumn(
        "order_status", F.when(F.col("order_id") == "o2", "canceled").otherwise(F.col("order_status"))
    )
    after = Models(changed, params)
    files = lambda: [p.name for f in (tmp_path / "ci/intermediate/customer_months").glob("v-*") for p in f.glob("purchase_month=*")]
    before = files()
    assert rows(history.fold_in(after, lake, touched)) == rows(after.int_customer_order_history) != rows(m.int_customer_order_history)
    assert 0 < len(files()) - len(before) <= len(touched) < len(every)
