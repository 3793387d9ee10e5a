import importlib
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from commerce_lake.operators.checks import Check, blocking, duplicate_keys, evaluate, freshness, orphans
from commerce_lake.plans import analytics
from commerce_lake.plans.build import PARENTS, build, finished, stored_model, with_ancestors
from commerce_lake.plans.models import Models
from commerce_lake.plans.quality import ModelTables, declared_checks, location_checks, run_checks
from commerce_lake.params import Params
from commerce_lake.sources import landing
from commerce_lake.sources.storage import Lake

build_module = importlib.import_module("commerce_lake.plans.build")


def test_79_declared_checks():
    checks = declared_checks(Params())
    kinds = Counter(c.kind for c in checks)
    assert len(checks) == 79
    assert kinds == {
        "unique": 18, "not_null": 28, "relationships": 8, "accepted_values": 4, "unique_combination": 4,
        "expression_is_true": 6, "fewer_rows_than": 1, "pair_a_at_least_b": 3, "row_count_between": 1,
        "expect_not_null": 2, "expect_between": 3, "expect_in_set": 1,
    }
    assert sum(c.severity == "warn" for c in checks) == 4


def test_fixture_fails_only_where_it_was_made_to(models):
    failed = {(r.check_name, r.model, r.column_name): r.failures for r in run_checks(models).collect() if not r.passed}
    # The padded customer id is two different raw values but one cleaned value,
    # so only the deliberate warnings remain.
    assert failed == {
        ("pair_a_at_least_b", "int_order_lifecycle", "order_approved_at,order_purchase_timestamp"): 1,
        ("expect_between", "fct_payments", "payment_installments"): 1,
    }


CASES = [
    (Check("unique", "t", ("k",)), 1),
    (Check("not_null", "t", ("k",)), 2),
    (Check("unique_combination", "t", ("k", "v")), 1),
    (Check("accepted_values", "t", ("s",), ("x",)), 2),
    (Check("expression_is_true", "t", ("v",), "v >= 0"), 1),
    (Check("pair_a_at_least_b", "t", ("v", "w")), 2),
    (Check("row_count_between", "t", (), (1, 3)), 1),
    (Check("row_count_between", "t", (), (6, 6)), 0),
    (Check("expect_between", "t", ("v",), (0, None)), 1),
    (Check("expect_between", "t", ("v",), (None, 2)), 1),
    (Check("expect_in_set", "t", ("v",), (1, 2)), 2),
    (Check("relationships", "t", ("k",), ("p", "id")), 1),
    (Check("fewer_rows_than", "p", (), "t"), 0),
    (Check("fewer_rows_than", "t", (), "p"), 1),
]


@pytest.mark.parametrize("check, failures", CASES)
def test_each_check_counts_failures_and_lets_nulls_pass(spark, check, failures):
    rows = [(1, 1, 0, "x"), (1, 1, 3, "x"), (2, 2, 2, "y"), (3, 7, None, "z"), (None, -1, 0, "x"), (None, None, 1, None)]
    tables = {
        "t": spark.createDataFrame(rows, "k int, v int, w int, s string"),
        "p": spark.createDataFrame([(1,), (2,)], "id int"),
    }
    row = evaluate(tables, [check]).first()
    assert (row.failures, row.passed) == (failures, failures == 0)


def test_dates_outside_a_band_fail(spark):
    df = spark.createDataFrame([(date(2020, 1, 1),), (date(2021, 1, 1),)], "d date")
    check = Check("expect_between", "t", ("d",), (date(2020, 1, 1), date(2020, 12, 31)))
    assert evaluate({"t": df}, [check]).first().failures == 1


def test_hot_key_is_counted_whole(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [(r.k, r.copies) for r in duplicate_keys(df, ["k"]).collect()] == [(-1, 1000)]
    parents = spark.range(3000).select(F.col("id").alias("id"))
    assert [(r.k, r.rows) for r in orphans(df, "k", parents, "id").collect()] == [(-1, 1000)]


def test_only_failed_errors_block(spark):
    df = spark.createDataFrame([(None,)], "k int")
    checks = [Check("not_null", "t", ("k",)), Check("expect_not_null", "t", ("k",), severity="warn"), Check("unique", "t", ("k",))]
    assert {r.check_name: r.blocks for r in blocking(evaluate({"t": df}, checks)).collect()} == {
        "not_null": True, "expect_not_null": False, "unique": False,
    }


@pytest.mark.parametrize("hours, status", [(35, "pass"), (37, "warn"), (73, "error")])
def test_freshness(spark, hours, status):
    loaded = datetime(2024, 1, 1)
    df = spark.createDataFrame([(loaded,), (datetime(2023, 1, 1),)], "loaded_at timestamp")
    now = datetime.fromtimestamp(loaded.timestamp() + hours * 3600)
    row = freshness(df, "loaded_at", now).first()
    assert (row.age_hours, row.status) == (float(hours), status)


def test_parents_come_before_children():
    seen = {"customers", "orders", "order_items", "order_payments", "order_reviews", "products", "sellers",
            "geolocation", "product_category_translation"}
    for model, parents in PARENTS.items():
        assert set(parents) <= seen, model
        seen.add(model)
    assert len(PARENTS) == 27
    assert with_ancestors(["fct_payments"]) == {"fct_payments", "stg_order_payments"}


def test_full_build_writes_marts_and_keeps_warnings_visible(spark, raw, params, models, tmp_path):
    lake = Lake(str(tmp_path), "ci")
    report = build(raw, lake, params)
    assert report.built == list(PARENTS) and not report.failed and not report.skipped
    assert len(report.results) == 81
    assert {w["model"] for w in report.warnings} == {"int_order_lifecycle", "fct_payments"}
    for name in ("fct_orders", "fct_order_items", "fct_reviews", "fct_payments", "dim_customer", "dim_seller"):
        lazy = getattr(models, name)
        stored = stored_model(spark, lake, name, lazy.schema)
        assert sorted(map(str, stored.collect())) == sorted(map(str, lazy.collect())), name
    assert list((tmp_path / "ci/marts/fct_orders").glob("v-*/order_purchase_date=2017-01-01"))
    opened = finished(raw, lake, params)
    assert opened.stored == {name for name in PARENTS if not name.startswith("stg_")}
    for analysis in (analytics.headline_metrics, analytics.top_cities, analytics.repeat_rate_by_first_category, analytics.city_tiers):
        assert sorted(map(str, analysis(opened).collect())) == sorted(map(str, analysis(models).collect()))
    assert spark.table("stg_sellers").count() == 2


def test_landed_and_loaded_snapshot_builds_the_same_marts(spark, incoming, params, models, tmp_path):
    stamp = datetime(2024, 5, 1)
    prefix = landing.land(spark, str(incoming), str(tmp_path / "zone"), stamp.date(), stamp)
    loaded = landing.load(spark, prefix, str(tmp_path / "raw"), "first", stamp)
    report = build(loaded, Lake(str(tmp_path)), params)
    assert report.built == list(PARENTS)
    lazy = models.fct_orders
    stored = stored_model(spark, Lake(str(tmp_path)), "fct_orders", lazy.schema)
    assert sorted(map(str, stored.collect())) == sorted(map(str, lazy.collect()))
    again = Models(loaded, params)
    assert analytics.sla_sales(again).columns == analytics.sla_sales(models).columns
    assert analytics.yearly_gmv(again).collect() == analytics.yearly_gmv(models).collect()
    assert again.mart_seller_by_location.count() == models.mart_seller_by_location.count()


def test_failed_check_stops_only_its_own_subtree(spark, raw, params, tmp_path):
    spoiled = dict(raw)
    spoiled["order_payments"] = raw["order_payments"].unionAll(raw["order_payments"])
    report = build(spoiled, Lake(str(tmp_path)), params)
    assert "stg_order_payments" in report.failed
    assert set(report.skipped) == {
        "int_order_payment_totals", "int_customer_order_history", "dim_customer", "fct_orders", "fct_payments",
    }
    assert {"fct_order_items", "fct_reviews", "dim_product", "dim_date"} <= set(report.built)
    assert not (tmp_path / "dev/marts/fct_payments").exists()


def test_an_exception_while_writing_stops_only_its_own_subtree(spark, raw, params, tmp_path):
    lake = Lake(str(tmp_path))
    build(raw, lake, params, only=["fct_payments", "dim_seller"])
    before = stored_model(spark, lake, "fct_payments").collect()
    spoiled = dict(raw)
    spoiled["order_payments"] = raw["order_payments"].withColumn("payment_value", F.raise_error(F.lit("lost")).cast("double"))
    report = build(spoiled, lake, params)
    assert "lost" in report.errors["fct_payments"] and "lost" in report.errors["int_order_payment_totals"]
    assert {"fct_order_items", "fct_reviews", "dim_product", "dim_seller"} <= set(report.built)
    assert {"fct_orders", "dim_customer"} <= set(report.skipped) | set(report.failed)
    # Readers still see what the build before has published.
    assert stored_model(spark, lake, "fct_payments").collect() == before


def test_single_rows_are_checked_in_the_pass_that_writes(raw, params, tmp_path, monkeypatch):
    asked = []
    plain = build_module.evaluate
    monkeypatch.setattr(build_module, "evaluate", lambda tables, checks: asked.extend(checks) or plain(tables, checks))
    report = build(raw, Lake(str(tmp_path)), params)
    assert len(report.results) == 81 and not report.failed
    later = [c for c in asked if not c.model.startswith("stg_") and c.model in PARENTS]
    assert {c.kind for c in later} == {"unique", "unique_combination", "relationships", "fewer_rows_than"}
    counted = {(r["check_name"], r["model"], r["column_name"]): r["failures"] for r in report.results}
    every = blocking(evaluate(ModelTables(Models(raw, params)), [*declared_checks(params), *location_checks()])).collect()
    assert counted == {(r.check_name, r.model, r.column_name): r.failures for r in every}


def test_order_totals_sum_the_written_payments(raw, params, models, tmp_path, monkeypatch):
    begun, plain = [], build_module.write_model
    monkeypatch.setattr(build_module, "write_model", lambda model, df, *rest: begun.append((model, df)) or plain(model, df, *rest))
    report = build(raw, Lake(str(tmp_path)), params, only=["int_order_payment_totals", "fct_payments"])
    assert {"int_order_payment_totals", "fct_payments"} <= set(report.built) and not report.failed
    names, made = [model for model, _ in begun], dict(begun)["int_order_payment_totals"]
    assert names.index("fct_payments") < names.index("int_order_payment_totals")
    assert any("/fct_payments/" in file for file in made.inputFiles())
    assert sorted(map(str, made.collect())) == sorted(map(str, models.int_order_payment_totals.collect()))
    # Totals are made from their own parents where payments are not written.
    begun.clear()
    alone = build(raw, Lake(str(tmp_path / "alone")), params, only=["int_order_payment_totals"])
    assert "fct_payments" not in alone.built and "int_order_payment_totals" in alone.built
    assert not any("/fct_payments/" in file for file in dict(begun)["int_order_payment_totals"].inputFiles())


def test_partial_build(raw, params, tmp_path):
    report = build(raw, Lake(str(tmp_path)), params, only=["dim_seller"])
    assert report.built == ["stg_sellers", "stg_geolocation", "int_geolocation_deduped", "dim_seller"]


def test_model_tables_prefer_raw_names(models):
    tables = ModelTables(models)
    assert tables["orders"] is models.raw["orders"] and tables["dim_seller"] is models.dim_seller


def test_an_old_load_gates_the_build(spark, raw, params, tmp_path):
    loaded = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 3))], "source string, loaded_at timestamp")
    lake = Lake(str(tmp_path))

    def built(hour, df=loaded, keys=()):
        return build(raw, lake, params, only=["dim_seller"], age=freshness(df, "loaded_at", datetime(2024, 1, 4, hour), keys))

    fresh = built(0)
    assert "dim_seller" in fresh.built and [r["passed"] for r in fresh.results if r["model"] == "loads"] == [True]
    before = stored_model(spark, lake, "dim_seller").inputFiles()
    # Per source the older one is beyond 72 hours; then nothing is written, and what stands stays.
    for late in (built(1, keys=["source"]), built(0, loaded.where("false"), keys=["source"]), built(0, loaded.where("false"))):
        assert not late.built and late.failed == ["loads"] and "dim_seller" in late.skipped
        assert stored_model(spark, lake, "dim_seller").inputFiles() == before
    # A day and a half is a warning, which is visible and stops nothing.
    warned = built(23)
    assert "dim_seller" in warned.built and [r["check_name"] for r in warned.warnings] == ["freshness"]


def test_a_build_from_the_last_load_knows_its_age(spark, incoming, params, tmp_path):
    only = {"sellers", "geolocation"}
    stamp = datetime(2024, 5, 1)
    landing.load(spark, str(incoming), str(tmp_path / "raw"), "first", stamp)
    age = lambda day: landing.load_freshness(spark, str(tmp_path / "raw"), stamp.replace(day=day))
    tables = {t: df for t, df in landing.read_raw(spark, str(tmp_path / "raw")).items() if t in only}
    assert build(tables, Lake(str(tmp_path)), params, only=["dim_seller"], checks=[], age=age(5)).built == []
    assert "dim_seller" in build(tables, Lake(str(tmp_path)), params, only=["dim_seller"], checks=[], age=age(2)).built
