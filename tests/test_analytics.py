from conftest import rows_by

from commerce_lake.functions import labels
from commerce_lake.plans import analytics, quality


def test_headline_metrics(models):
    row = analytics.headline_metrics(models).first()
    assert (row.orders_total, row.order_lines_total, row.customers_total) == (8, 10, 5)
    assert row.revenue_orders == 7 and row.revenue_orders_pct == 87.5
    assert row.product_revenue_brl == 600.0
    assert row.repeat_rate_placed_pct == 40.0 and row.repeat_rate_delivered_pct == 20.0
    assert row.late_rate_of_delivered_pct == 40.0
    assert row.pct_orders_with_review == 50.0
    assert row.median_lifetime_revenue_brl == 66.0


def test_reviews_by_lateness_counts_order_review_pairs(models):
    buckets = rows_by(analytics.reviews_by_lateness(models), "delivery_bucket")
    assert buckets["0  on time / early"].orders == 2
    assert buckets["2  4-7 days late"].avg_review_score == 2.0
    assert buckets["4  16+ days late"].dissatisfied_rate_pct == 100.0


def test_revenue_by_lateness_sums_to_hundred(models):
    rows = analytics.revenue_by_lateness(models).collect()
    assert abs(sum(r.pct_revenue for r in rows) - 100) < 0.1
    assert {r.delivery_bucket: r.revenue for r in rows}["4  16+ days late"] == 200.0


def test_first_experience_uses_first_order_with_ties_broken_by_id(models):
    rows = rows_by(analytics.value_by_first_experience(models), "first_experience")
    # C ordered after the cut-off; D's first order is o6, the lower id.
    assert {k: r.customers for k, r in rows.items()} == {
        labels.FIRST_ON_TIME: 2, labels.FIRST_LATE: 1, labels.FIRST_UNDELIVERED: 1,
    }


def test_second_order_timing(models):
    row = analytics.second_order_timing(models).first()
    assert (row.repeat_customers, row.median_gap_days, row.p25_gap_days) == (2, 10.0, 5.0)
    assert row.within_30_days_pct == 100.0
    bins = analytics.second_order_histogram(models).collect()
    assert [(b.bin, b.customers) for b in bins] == [(1, 1), (37, 1)]


def test_first_category_is_that_of_the_dearest_line(models):
    rows = rows_by(analytics.repeat_rate_by_first_category(models), "category")
    # B's first order ties at 20.00 between p1 and p2: the lower line number wins.
    assert rows["health_beauty"].customers == 3 and rows["furniture"].customers == 1


def test_segments_and_what_if(models):
    segments = rows_by(analytics.order_count_segments(models), "segment")
    assert {k: r.customers for k, r in segments.items()} == {"1 order": 3, "2 orders": 1, "3 orders": 1}
    what_if = analytics.repeat_rate_what_if(models).collect()
    assert [r.target for r in what_if] == [0.04, 0.05, 0.06]
    assert what_if[0].extra_repeat_customers == round(5 * (0.04 - 0.4))


def test_states_regions_and_running_share(models):
    states = analytics.revenue_by_state(models).collect()
    assert states[0].state == "SP" and states[0].region == "Southeast"
    assert states[-1].cum_pct_revenue == 100.0
    regions = rows_by(analytics.revenue_by_region(models), "region")
    assert set(regions) == {"Southeast", "Northeast", "North"}
    assert sum(r.orders for r in regions.values()) == 7


def test_city_queries_agree_with_each_other(models):
    cities = analytics.top_cities(models).collect()
    assert cities[0].city == "santos / SP" and cities[0].city_label == "santos"
    assert cities[-1].cum_pct_revenue == 100.0
    concentration = analytics.revenue_concentration(models).first()
    assert concentration.city_values == len(cities) == 4
    assert concentration.top_1_pct == round(cities[0].pct_revenue, 1)
    tiers = rows_by(analytics.city_tiers(models), "tier")
    # All four cities lead and all are in the tail: the tiers overlap.
    assert tiers[labels.tier_top(models.params)].n_cities == 4 and tiers[labels.tier_tail(models.params)].n_cities == 4
    assert tiers[labels.tier_mid(models.params)].n_cities == 0 and tiers[labels.tier_mid(models.params)].revenue_pct == 0.0


def test_city_leaders_need_coordinates(models):
    rows = analytics.cities_with_top_customer(models).collect()
    assert [(r.name, r.top_customer_key, r.customer_count) for r in rows] == [("rio", "B", 1), ("natal", "C", 1)]


def test_city_records_are_plain_json(models):
    import json

    record = json.loads(analytics.cities_json(models).first().city)
    assert record["name"] == "rio" and record["total_lifetime_revenue"] == 55.0


def test_sla_sales_and_gmv(models):
    sales = analytics.sla_sales(models)
    assert sorted({r.order_id for r in sales.collect()}) == ["o1", "o3", "o4"]
    assert float(analytics.yearly_gmv(models).first().gmv) == 180.0


def test_static_regions_cover_27_states(spark):
    rows = labels.state_regions(spark).collect()
    assert len(rows) == len({r.state for r in rows}) == 27


def test_validations(models):
    assert all(r.matches for r in quality.row_counts_against_raw(models).collect())
    assert all(r.matches for r in quality.control_totals(models).collect())
    mismatches = quality.rollup_mismatches(models).first()
    assert (mismatches.gross_mismatches, mismatches.line_count_mismatches, mismatches.payment_mismatches) == (0, 0, 0)
    assert all(r.orphans == 0 for r in quality.orphan_counts(models).collect())
    coverage = quality.date_coverage(models).first()
    assert coverage.contiguous and coverage.missing_days == 0
    gaps = quality.known_gaps(models).first()
    assert (gaps.orders_without_items, gaps.sellers_without_point, gaps.unknown_products) == (1, 1, 2)
    assert quality.reconciliation_rate(models).first().reconciled_orders == 7
