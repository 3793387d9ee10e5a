"""C1-C14, V1-V6 and Q6: checks and validations."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.bindings import TEST_PARAMS, raw_tables, read
from commerce_lake.catalog.common import Query, over_models, over_tables, with_views
from commerce_lake.catalog.views import VIEWS
from commerce_lake.operators.checks import Check, blocking, evaluate, freshness
from commerce_lake.plans import quality
from commerce_lake.plans.build import PARENTS, BuildReport, build, layer_of, stored_model
from commerce_lake.sources.storage import Lake, shared_folder

_KINDS = {
    "C1_unique": ("unique",),
    "C2_not_null": ("not_null",),
    "C3_relationships": ("relationships",),
    "C4_accepted_values": ("accepted_values",),
    "C5_unique_combination": ("unique_combination",),
    "C6_expression_is_true": ("expression_is_true", "fewer_rows_than"),
    "C7_pair_a_at_least_b": ("pair_a_at_least_b",),
    "C8_row_count_between": ("row_count_between",),
    "C9_expect_not_null": ("expect_not_null",),
    "C10_expect_between": ("expect_between",),
    "C11_expect_in_set": ("expect_in_set",),
    "C14_grain_guard": ("fewer_rows_than",),
}

# Views of the oracles, where they are named differently from the models.
_VIEW_OF = {
    "customers": "raw_customers", "orders": "raw_orders",
    "stg_product_category_translation": "stg_translation", "int_geolocation_deduped": "zip_points",
    "int_order_lifecycle": "lifecycle", "int_order_payment_totals": "order_totals",
    "int_customer_order_history": "history", "geo_dim_product": "geo_product",
}


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float)) else f"'{value}'"


def _failures(check: Check) -> str:
    """Failing rows or keys of a check, spelled as a scalar subquery."""
    view = _VIEW_OF.get(check.model, check.model)
    keys = ", ".join(check.columns)
    col = check.columns[0] if check.columns else None
    if check.kind in ("unique", "unique_combination"):
        present = " AND ".join(f"{c} IS NOT NULL" for c in check.columns)
        return f"SELECT count(*) FROM (SELECT {keys} FROM {view} WHERE {present} GROUP BY {keys} HAVING count(*) > 1)"
    if check.kind == "relationships":
        parent, parent_key = check.args
        parent = _VIEW_OF.get(parent, parent)
        return f"SELECT count(*) FROM {view} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {parent_key} FROM {parent})"
    if check.kind == "fewer_rows_than":
        return f"SELECT ((SELECT count(*) FROM {view}) >= (SELECT count(*) FROM {check.args}))::BIGINT"
    if check.kind == "row_count_between":
        return f"SELECT (count(*) NOT BETWEEN {check.args[0]} AND {check.args[1]})::BIGINT FROM {view}"
    if check.kind in ("not_null", "expect_not_null"):
        bad = f"{col} IS NULL"
    elif check.kind in ("accepted_values", "expect_in_set"):
        bad = f"{col} NOT IN ({', '.join(map(_literal, check.args))})"
    elif check.kind == "pair_a_at_least_b":
        bad = f"{col} < {check.columns[1]}"
    elif check.kind == "expect_between":
        low, high = check.args
        bad = " OR ".join(
            f"{col} {op} {_literal(limit)}" for op, limit in (("<", low), (">", high)) if limit is not None
        )
    else:
        bad = f"NOT ({check.args})"
    return f"SELECT count(*) FROM {view} WHERE {bad}"


def _oracle(checks: list[Check]) -> str:
    rows = [
        f"SELECT '{c.kind}' AS check_name, '{c.model}' AS model, '{c.label}' AS column_name, "
        f"'{c.severity}' AS severity, ({_failures(c)}) AS failures"
        for c in checks
    ]
    body = "SELECT *, failures = 0 AS passed FROM (" + "\nUNION ALL ".join(rows) + ")"
    return with_views(VIEWS, body)


_DECLARED = quality.declared_checks(TEST_PARAMS)

QUERIES: dict[str, Query] = {
    name: over_models(lambda m, kinds=kinds: quality.run_checks(m, *kinds)) for name, kinds in _KINDS.items()
}
ORACLES: dict[str, str] = {
    name: _oracle([c for c in _DECLARED if c.kind in kinds]) for name, kinds in _KINDS.items()
}


# Checks that fail on the test tables as they are, to see failures counted.

_LINE_CHECKS = [
    Check("unique_combination", "lineitem", ("l_orderkey", "l_linenumber")),
    Check("expect_between", "lineitem", ("l_quantity",), (1, 40), "warn"),
    Check("expect_in_set", "lineitem", ("l_returnflag",), ("A", "N")),
    Check("relationships", "lineitem", ("l_partkey",), ("orders", "o_orderkey")),
]


@over_tables("lineitem", "orders")
def _severity_gate(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return blocking(evaluate({"lineitem": lineitem, "orders": orders}, _LINE_CHECKS))


QUERIES["C13_severity_gate"] = _severity_gate
ORACLES["C13_severity_gate"] = """
    SELECT *, failures = 0 AS passed, severity = 'error' AND failures > 0 AS blocks FROM (
      SELECT 'unique_combination' AS check_name, 'lineitem' AS model, 'l_orderkey,l_linenumber' AS column_name, 'error' AS severity,
             (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS failures
      UNION ALL SELECT 'expect_between', 'lineitem', 'l_quantity', 'warn', (SELECT count(*) FROM lineitem WHERE l_quantity > 40 OR l_quantity < 1)
      UNION ALL SELECT 'expect_in_set', 'lineitem', 'l_returnflag', 'error', (SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))
      UNION ALL SELECT 'relationships', 'lineitem', 'l_partkey', 'error', (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT o_orderkey FROM orders)))"""


@over_tables("events")
def _freshness(events: DataFrame) -> DataFrame:
    return freshness(events, "ts", datetime(2024, 2, 1, 11, 30), keys=["event_type"])


QUERIES["C12_freshness"] = _freshness
ORACLES["C12_freshness"] = """
    SELECT event_type, round(age, 2) AS age_hours,
           CASE WHEN age <= 36 THEN 'pass' WHEN age <= 72 THEN 'warn' ELSE 'error' END AS status
    FROM (SELECT event_type, date_sub('second', max(ts)::TIMESTAMP, TIMESTAMP '2024-02-01 11:30:00') / 3600.0::DOUBLE AS age
          FROM events GROUP BY 1)"""

QUERIES["C1b_location_product_key"] = over_models(
    lambda m: evaluate(quality.ModelTables(m), quality.location_checks())
)
ORACLES["C1b_location_product_key"] = _oracle(quality.location_checks())

_VALIDATIONS = {
    "V1_row_counts_against_raw": (
        quality.row_counts_against_raw,
        """SELECT *, raw_rows = mart_rows AS matches FROM (
             SELECT 'fct_order_items' AS model, (SELECT count(*) FROM lineitem) AS raw_rows, (SELECT count(*) FROM fct_order_items) AS mart_rows
             UNION ALL SELECT 'fct_orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM fct_orders)
             UNION ALL SELECT 'fct_payments', (SELECT count(*) FROM raw_order_payments), (SELECT count(*) FROM fct_payments)
             UNION ALL SELECT 'fct_reviews', (SELECT count(DISTINCT review_id) FROM raw_order_reviews), (SELECT count(*) FROM fct_reviews))"""),
    "V2_control_totals": (
        quality.control_totals,
        """SELECT measure, a::DOUBLE AS raw_total, b::DOUBLE AS mart_total, a = b AS matches FROM (
             SELECT 'price' AS measure, (SELECT sum(price::DECIMAL(18,2)) FROM raw_order_items) AS a, (SELECT sum(price) FROM fct_order_items) AS b
             UNION ALL SELECT 'freight_value', (SELECT sum(freight_value::DECIMAL(18,2)) FROM raw_order_items), (SELECT sum(freight_value) FROM fct_order_items)
             UNION ALL SELECT 'payment_value', (SELECT sum(payment_value::DECIMAL(18,2)) FROM raw_order_payments), (SELECT sum(payment_value) FROM fct_payments))"""),
    "V3_rollup_mismatches": (
        quality.rollup_mismatches,
        """SELECT count(*) AS orders, count(*) FILTER (item_gross_total <> coalesce(g, 0)) AS gross_mismatches,
                  count(*) FILTER (item_count <> coalesce(n, 0)) AS line_count_mismatches,
                  count(*) FILTER (payment_value_total <> coalesce(p, 0)) AS payment_mismatches
           FROM fct_orders LEFT JOIN (SELECT order_id, sum(line_gross_value) AS g, count(*) AS n FROM fct_order_items GROUP BY 1) USING (order_id)
           LEFT JOIN (SELECT order_id, sum(payment_value) AS p FROM fct_payments GROUP BY 1) USING (order_id)"""),
    "V4_orphan_counts": (
        quality.orphan_counts,
        "\nUNION ALL ".join(
            f"SELECT '{c.model}' AS model, '{c.columns[0]}' AS key, ({_failures(c)}) AS orphans"
            for c in _DECLARED if c.kind == "relationships" and c.model.startswith("fct_")
        )),
    "V5_date_coverage": (
        quality.date_coverage,
        """SELECT days, span_days, days = span_days AS contiguous,
                  (SELECT count(DISTINCT order_purchase_date) FROM fct_orders
                   WHERE order_purchase_date NOT IN (SELECT date_key FROM dim_date)) AS missing_days
           FROM (SELECT count(*) AS days, max(date_key) - min(date_key) + 1 AS span_days FROM dim_date)"""),
    "V6_known_gaps": (
        quality.known_gaps,
        """SELECT (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS orders_without_items,
                  count(*) FILTER (customer_latitude IS NULL) AS customers_without_point,
                  (SELECT count(*) FROM dim_seller WHERE seller_latitude IS NULL) AS sellers_without_point,
                  (SELECT count(*) FROM dim_product WHERE product_category_name_english = 'unknown') AS unknown_products,
                  count(*) FILTER (is_repeat_customer) AS repeat_by_delivered,
                  count(*) FILTER (order_count > 1) AS repeat_by_placed FROM dim_customer"""),
    "Q6_reconciliation_rate": (
        quality.reconciliation_rate,
        """SELECT count(*) AS orders, count(*) FILTER (is_payment_reconciled) AS reconciled_orders,
                  round(100.0::DOUBLE * count(*) FILTER (is_payment_reconciled) / count(*), 2) AS reconciled_pct FROM order_totals"""),
}

_BAND_CHECK = Check("row_count_between", "fct_orders", (), (1, 10))
_KEPT_CHECK = Check("row_count_between", "dim_date", (), (1, 100_000))


def _gated_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build in which one check fails: its model counts as failed, what is
    made from it is skipped, the rest is written; rows per written table."""
    lake = Lake(f"{shared_folder(spark)}/catalog/C15-{uuid.uuid4().hex}", "ci")
    raw = raw_tables(spark, sf_dir)
    report = build(raw, lake, TEST_PARAMS, checks=[Check("row_count_between", "geo_dim_product", (), (0, 0)), _BAND_CHECK, _KEPT_CHECK])
    stored = finished_tables(spark, lake, report)
    states = [(m, "failed" if m in report.failed else "built") for m in report.built] + [(m, "skipped") for m in report.skipped]
    rows = spark.createDataFrame(states, "model string, state string")
    counts = None
    for name, df in stored.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionAll(one)
    return rows.join(counts, rows["model"] == counts["name"], "left").select("model", "state", "n")


def finished_tables(spark: SparkSession, lake: Lake, report: BuildReport) -> dict[str, DataFrame]:
    """Tables that a build wrote; staging stays a view."""
    return {m: stored_model(spark, lake, m) for m in report.built if layer_of(m) != "staging"}


def _fresh_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build from loads that are fresh, late, or too old as of three moments:
    the last writes nothing. One row per moment: models written, rows of one."""
    raw, events = raw_tables(spark, sf_dir), read(spark, sf_dir, "events")
    newest = events.agg(F.max("ts")).first()[0]
    rows = None
    for moment, hours in (("fresh", 35), ("late", 37), ("old", 73)):
        lake = Lake(f"{shared_folder(spark)}/catalog/C12-{uuid.uuid4().hex}", moment)
        age = freshness(events, "ts", newest + timedelta(hours=hours))
        report = build(raw, lake, TEST_PARAMS, only=["dim_seller"], checks=[], age=age)
        marts = finished_tables(spark, lake, report)
        found = marts["dim_seller"] if "dim_seller" in marts else raw["sellers"].where("false")
        one = found.agg(F.count("*").alias("sellers")).select(
            F.lit(moment).alias("moment"), F.lit(len(report.built)).alias("built"), F.lit(len(report.warnings)).alias("warnings"), "sellers"
        )
        rows = one if rows is None else rows.unionAll(one)
    return rows


QUERIES["C12b_gate_on_freshness"] = _fresh_build
ORACLES["C12b_gate_on_freshness"] = """
    SELECT 'fresh' AS moment, 4 AS built, 0 AS warnings, count(*) AS sellers FROM supplier
    UNION ALL SELECT 'late', 4, 1, count(*) FROM supplier UNION ALL SELECT 'old', 0, 0, 0"""

_BUILT_VIEW = {
    "dim_date": "(SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)))",
    "geo_dim_geolocation": "geo_zip", "fact_sale_order_location": "geo_sales",
    "mart_revenue_by_location": "geo_places",
}
_SKIPPED = ("fact_revenue_by_product_seller_location", "mart_seller_by_location")
_FAILED = ("fct_orders", "geo_dim_product")
QUERIES["C15_gated_build"] = _gated_build
ORACLES["C15_gated_build"] = with_views(VIEWS, "\nUNION ALL ".join(
    f"SELECT '{m}' AS model, '{'skipped' if m in _SKIPPED else 'failed' if m in _FAILED else 'built'}' AS state, "
    + ("NULL::BIGINT" if m in _SKIPPED or layer_of(m) == "staging" else f"(SELECT count(*) FROM {_BUILT_VIEW.get(m) or _VIEW_OF.get(m, m)})")
    + " AS n" for m in PARENTS))

QUERIES.update({name: over_models(build) for name, (build, _) in _VALIDATIONS.items()})
ORACLES.update({name: with_views(VIEWS, sql) for name, (_, sql) in _VALIDATIONS.items()})
