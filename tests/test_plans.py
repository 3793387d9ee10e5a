"""Shapes of the plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from commerce_lake.catalog import all_queries
from commerce_lake.catalog.common import models as bound_models
from commerce_lake.functions.text import WHITE_SPACE
from commerce_lake.operators.prefix import running_sums
from commerce_lake.plans import analytics, colocated, quality
from commerce_lake.plans.models import Models
from commerce_lake.session import ADVISORY, TASK_BYTES, tune
from commerce_lake.sources.storage import Lake

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bound(spark):
    return bound_models(spark, SF)


@pytest.mark.parametrize(
    "build",
    [lambda m: m.stg_order_reviews, analytics.value_by_first_experience, analytics.second_order_gaps,
     analytics.repeat_rate_by_first_category],
)
def test_ranks_are_limited_before_the_shuffle(bound, build):
    plan = plan_of(build(bound))
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    # A rank over rows that a join left in place needs no shuffle and no partial limit.
    assert plan.count("WindowGroupLimit") >= 2


def test_unused_totals_are_not_computed(bound):
    plan = plan_of(analytics.revenue_by_lateness(bound))
    assert "l_linenumber" not in plan, "payments are not needed for product revenue"


def test_filters_and_columns_reach_the_scan(spark):
    from commerce_lake.bindings import read

    items = read(spark, SF, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    plan = plan_of(items)
    assert "EqualTo(l_returnflag,R)" in plan and "l_comment" not in plan
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>", plan)


EVERY_MODEL = [n for n in dir(Models) if n.startswith(("stg_", "int_", "dim_", "fct_", "fact_", "mart_"))]


@pytest.mark.parametrize("name", EVERY_MODEL)
def test_no_model_joins_without_a_key_or_runs_python(bound, name):
    plan = plan_of(getattr(bound, name))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|MapInPandas", plan)


def test_cities_are_aggregated_once(bound):
    for query in (analytics.revenue_concentration, analytics.city_tiers):
        df = query(bound)
        df.collect()
        assert "ReusedExchange" in plan_of(df), query.__name__


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def scans_of(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", plan))


def final_plan(df) -> str:
    """What adaptive execution ran, without the plans it started from."""
    df.collect()
    lines, initial = [], None
    for line in plan_of(df).replace(WHITE_SPACE, "").split("\n"):  # a plan's node is one line
        depth = len(line) - len(line.lstrip(" :"))
        if initial is not None and depth > initial:
            continue
        initial = depth if "== Initial Plan ==" in line else None
        lines.append(line)
    return "\n".join(lines)


@pytest.mark.parametrize("name", ["A0.1_headline_metrics", "G10_count_distinct"])
def test_distinct_counts_copy_no_rows(no_broadcasts, name):
    assert "Expand" not in final_plan(all_queries()[name](no_broadcasts, SF))


@pytest.mark.parametrize("name", ["M10_int_geolocation_deduped", "M14_dim_customer", "M17_dim_seller", "A4.1_cities_with_top_customer"])
def test_coordinates_are_read_once(no_broadcasts, name):
    plan = final_plan(all_queries()[name](no_broadcasts, SF))
    assert scans_of(plan, "customer") == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["M26_mart_revenue_by_location", "M27_mart_seller_by_location"])
def test_location_marts_count_rows(no_broadcasts, name):
    assert "distinct" not in final_plan(all_queries()[name](no_broadcasts, SF))


def test_top_cities_are_summed_once(no_broadcasts):
    plan = final_plan(all_queries()["A3.2_top_cities"](no_broadcasts, SF))
    # Orders are read as orders, as customers and for their sums, each once.
    assert scans_of(plan, "orders") <= 4
    total = plan[plan.index("Subquery"):]
    assert "Join" not in total[: total.index("ReusedExchange")]


def test_yearly_sums_precede_the_product_join(no_broadcasts):
    plan = final_plan(all_queries()["A4.3_yearly_gmv"](no_broadcasts, SF))
    assert [scans_of(plan, t) for t in ("part", "lineitem", "orders")] == [1, 1, 1]
    products = plan.index("/part.parquet")
    join = plan.rindex("SortMergeJoin", 0, products)
    assert "HashAggregate" in plan[join:products], "lines are summed below the join with products"


def test_headline_metrics_sum_lines_once_for_both_distinct_counts(no_broadcasts):
    plan = final_plan(all_queries()["A0.1_headline_metrics"](no_broadcasts, SF))
    assert scans_of(plan, "lineitem") <= 4 and scans_of(plan, "orders") <= 7


def test_reference_checks_read_every_fact_once_for_all_its_keys(no_broadcasts):
    plan = final_plan(all_queries()["C3_relationships"](no_broadcasts, SF))
    # Lines are read as lines with three keys, as payments, and for customers' payments; reviews once.
    assert scans_of(plan, "events") == 1 and scans_of(plan, "lineitem") <= 3


def test_stored_by_order_needs_no_shuffle(no_broadcasts, tmp_path):
    m, lake = bound_models(no_broadcasts, SF), Lake(str(tmp_path), "ci")
    colocated.store_by_order(m, lake, buckets=4)
    opened = colocated.opened_by_order(m, lake)
    for name in ("fct_order_items", "fct_orders", "int_order_payment_totals"):
        plan = final_plan(getattr(opened, name))
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan, name
        assert sorted(map(str, getattr(opened, name).collect())) == sorted(map(str, getattr(m, name).collect()))
    assert quality.rollup_mismatches(opened).collect() == quality.rollup_mismatches(m).collect()
    # One file a bucket, and a new version leaves those who read the old one alone.
    assert len(list((tmp_path / "ci/by_order/stg_order_items").glob("v-*/*.parquet"))) == 4
    before = opened.fct_order_items
    fewer = m.stg_order_items.where(F.col("price") < 0)
    assert colocated.write_bucketed(fewer, lake.path("by_order", "stg_order_items"), "order_id", 4).count() == 0
    assert before.count() > 0 and colocated.opened_by_order(m, lake).fct_order_items.count() == 0


def test_running_sums_hold_no_table_in_one_task(no_broadcasts):
    df = no_broadcasts.range(0, 5000, 1, 8).select("id", (F.col("id") % 7).alias("v"))
    summed = running_sums(df, [F.desc("v"), F.col("id")], {"so_far": "v"})
    plan = final_plan(summed)
    assert plan.count("Window") == 2 and "rangepartitioning" not in plan.split("FileScan")[0]
    # The only window over all rows sees one row per partition.
    assert plan.count("SinglePartition") == 1


def test_stored_by_order_takes_buckets_by_rows(no_broadcasts, tmp_path, monkeypatch):
    m, lake = bound_models(no_broadcasts, SF), Lake(str(tmp_path), "ci")
    monkeypatch.setattr(colocated, "BUCKET_ROWS", 1000)
    most = max(m.stg_order_items.count(), m.stg_order_payments.count())
    buckets = -(-most // 1000)
    assert buckets > 4 and colocated.enough_buckets(m, buckets + 1) == buckets + 1
    colocated.store_by_order(m, lake, buckets=4)
    opened = colocated.opened_by_order(m, lake)
    plan = final_plan(opened.fct_orders)
    assert "Exchange" not in plan and f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
    assert sorted(map(str, opened.fct_orders.collect())) == sorted(map(str, m.fct_orders.collect()))


def test_a_task_takes_little_shuffled_data_unless_the_session_says_more(spark):
    session = spark.newSession()
    session.conf.unset(ADVISORY)
    assert tune(session).conf.get(ADVISORY) == TASK_BYTES
    session.conf.set(ADVISORY, "32m")
    assert tune(session).conf.get(ADVISORY) == "32m"
