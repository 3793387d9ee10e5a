"""Layered build in which a model's checks gate the models that use it."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from commerce_lake.operators.checks import ERROR, Check, blocking, evaluate, failures, result_of
from commerce_lake.params import Params
from commerce_lake.plans.models import Models
from commerce_lake.plans.quality import ModelTables, declared_checks, location_checks
from commerce_lake.sources import versions
from commerce_lake.sources.storage import Lake, write_clustered, write_partitioned, write_table

# Each model with the tables it is made from, parents before children.
PARENTS: dict[str, tuple[str, ...]] = {
    "stg_customers": ("customers",),
    "stg_orders": ("orders",),
    "stg_order_items": ("order_items",),
    "stg_order_payments": ("order_payments",),
    "stg_order_reviews": ("order_reviews",),
    "stg_products": ("products",),
    "stg_sellers": ("sellers",),
    "stg_geolocation": ("geolocation",),
    "stg_product_category_translation": ("product_category_translation",),
    "int_geolocation_deduped": ("stg_geolocation",),
    "int_order_lifecycle": ("stg_orders", "stg_customers"),
    "int_order_payment_totals": ("stg_orders", "stg_order_payments", "stg_order_items"),
    "int_customer_order_history": ("stg_customers", "stg_orders", "int_order_payment_totals"),
    "dim_customer": ("int_customer_order_history", "int_geolocation_deduped"),
    "dim_date": (),
    "dim_product": ("stg_products", "stg_product_category_translation"),
    "dim_seller": ("stg_sellers", "int_geolocation_deduped"),
    "fct_order_items": ("stg_order_items", "int_order_lifecycle"),
    "fct_orders": ("int_order_lifecycle", "int_order_payment_totals"),
    "fct_payments": ("stg_order_payments",),
    "fct_reviews": ("stg_order_reviews",),
    "geo_dim_geolocation": ("geolocation",),
    "geo_dim_product": ("products", "product_category_translation"),
    "fact_sale_order_location": ("orders", "customers", "order_payments", "geo_dim_geolocation"),
    "fact_revenue_by_product_seller_location": (
        "order_items", "orders", "geo_dim_product", "sellers", "geo_dim_geolocation",
    ),
    "mart_revenue_by_location": ("fact_sale_order_location",),
    "mart_seller_by_location": ("fact_revenue_by_product_seller_location",),
}

# Models that are made from another one where it is written, and from its parents
# where it is not: they start after it, but do not fail with it.
READS_IF_WRITTEN = {"int_order_payment_totals": "fct_payments"}

# Day column and cluster columns.
PARTITIONED = {
    "fct_order_items": ("order_purchase_date", ("product_key", "seller_key")),
    "fct_orders": ("order_purchase_date", ("customer_key", "order_status")),
    "fct_reviews": ("review_creation_date", ("order_id",)),
}
# Sort columns; the last one separates the rows of one large key.
CLUSTERED = {
    "fct_payments": ("order_id", "payment_sequential"),
    "dim_customer": ("customer_key",),
    "dim_date": ("date_key",),
    "dim_product": ("product_key",),
    "dim_seller": ("seller_key",),
}


@dataclass
class BuildReport:
    built: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    results: list[dict] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def warnings(self) -> list[dict]:
        return [r for r in self.results if not r["passed"] and r["severity"] == "warn"]


def layer_of(model: str) -> str:
    return {"stg": "staging", "int": "intermediate"}.get(model.split("_")[0], "marts")


def with_ancestors(models: list[str]) -> set[str]:
    """The given models and everything they are made from."""
    wanted: set[str] = set()
    pending = list(models)
    while pending:
        name = pending.pop()
        if name in PARENTS and name not in wanted:
            wanted.add(name)
            pending.extend(PARENTS[name])
    return wanted


def write_model(
    model: str, df: DataFrame, lake: Lake, watch: Mapping[str, Column] | None = None, seen: dict | None = None
) -> DataFrame:
    """Staging stays a view. Later layers are written once and read many times:
    the table also cuts the lineage, so a lost executor repeats little work.
    `watch` names aggregates that the writing pass computes into `seen`."""
    path = lake.path(layer_of(model), model)
    if layer_of(model) == "staging":
        df.createOrReplaceTempView(model)
        return df
    if model in PARTITIONED:
        return write_partitioned(df, path, *PARTITIONED[model], watch, seen)
    if model in CLUSTERED:
        return write_clustered(df, path, CLUSTERED[model], watch, seen)
    return write_table(df, path, watch, seen)


def _tables_of(check: Check) -> set[str]:
    other = {"relationships": lambda: {check.args[0]}, "fewer_rows_than": lambda: {check.args}}
    return {check.model} | other.get(check.kind, set)()


def _write_and_check(model: str, df: DataFrame, lake: Lake, checks: list[Check]) -> tuple[DataFrame, list[dict]]:
    """Write a model; its row-level checks are counted in the same pass."""
    watch, seen = {f"check_{k}": failures(check) for k, check in enumerate(checks)}, {}
    stored = write_model(model, df, lake, watch, seen)
    return stored, [result_of(check, seen[f"check_{k}"]) for k, check in enumerate(checks)]


class _Run:
    """State of one build: what is written, what is being checked, what has failed."""

    def __init__(self, m: Models, lake: Lake, checks: list[Check], raw: Mapping[str, DataFrame]) -> None:
        self.m, self.lake, self.tables = m, lake, ModelTables(m)
        self.pending, self.ready = checks, set(raw)
        self.report = BuildReport()
        self.checked_now: list[str] = []  # models whose checks are running

    def record(self, rows: list[dict]) -> None:
        for row in rows:
            self.report.results.append(row)
            if row["blocks"]:
                self.fail(row["model"])

    def fail(self, model: str, error: BaseException | None = None) -> None:
        if model not in self.report.failed:
            self.report.failed.append(model)
        if error is not None:
            self.report.errors[model] = f"{type(error).__name__}: {error}"

    def stopped(self, model: str) -> bool:
        return any(p in self.report.failed or p in self.report.skipped for p in PARENTS[model])

    def may_start(self, model: str) -> bool:
        return all(p in self.ready and p not in self.checked_now for p in PARENTS[model])

    def write(self, model: str, pool: ThreadPoolExecutor) -> Future:
        while_writing = [c for c in self.pending if c.model == model and failures(c) is not None and layer_of(model) != "staging"]
        for check in while_writing:
            self.pending.remove(check)
        return pool.submit(lambda: _write_and_check(model, getattr(self.m, model), self.lake, while_writing))

    def due(self) -> list[Check]:
        """Checks whose tables are all there; they are handed out once."""
        found = [c for c in self.pending if _tables_of(c) <= self.ready]
        for check in found:
            self.pending.remove(check)
        return found

    def evaluated(self, checks: list[Check]) -> list[dict]:
        return [row.asDict() for row in blocking(evaluate(self.tables, checks)).collect()]


def load_results(age: DataFrame) -> list[dict]:
    """Freshness of loads as check results; no load at all is too old."""
    found = age.groupBy("status").agg(F.count("*").alias("n")).collect()  # three rows at most
    late = {r.status: r.n for r in found if r.status != "pass"}
    if not found:
        late = {ERROR: 1}
    counts = late or {ERROR: 0}
    return [result_of(Check("freshness", "loads", ("loaded_at",), severity=s), n) for s, n in sorted(counts.items())]


def build(
    raw: Mapping[str, DataFrame],
    lake: Lake,
    params: Params | None = None,
    only: list[str] | None = None,
    checks: list[Check] | None = None,
    threads: int = 4,
    age: DataFrame | None = None,
) -> BuildReport:
    """Write every model, running each check once the tables it names are there.

    Up to `threads` models whose parents are ready are written, or checked, side
    by side. Checks of single rows and row counts are counted in the pass that
    writes their model; the others run beside further writes. A failed error
    check, or an exception while writing, marks its model as failed and
    everything downstream of it as skipped; unrelated models go on, and what an
    earlier build has published of a failed write stays in place. Only check
    results, one row per declared check, come to the driver.

    `age` is the freshness of what is built from (`landing.load_freshness`, or
    `operators.checks.freshness` of any tables): one of status error, or none at
    all, skips every model before anything is written, and what stands stays.
    """
    fresh = load_results(age) if age is not None else []
    m = Models(raw, params)
    declared = checks if checks is not None else [*declared_checks(m.params), *location_checks()]
    selected = with_ancestors(only) if only else set(PARENTS)
    run = _Run(m, lake, list(declared), raw)
    waiting = [model for model in PARENTS if model in selected]
    run.record(fresh)
    if "loads" in run.report.failed:
        run.report.skipped = waiting
        return run.report
    with ThreadPoolExecutor(threads) as pool:
        writing: dict[Future, str] = {}
        checking: dict[Future, list[Check]] = {}

        def check_what_is_due() -> None:
            if found := run.due():
                run.checked_now += [c.model for c in found]
                checking[pool.submit(run.evaluated, found)] = found

        def comes_first(model: str) -> bool:
            """Whether a model that this one reads if it is written is still to come."""
            return READS_IF_WRITTEN.get(model) in [*waiting, *writing.values()]

        check_what_is_due()
        while waiting or writing or checking:
            for model in list(waiting):
                if run.stopped(model):
                    run.report.skipped.append(model)
                    waiting.remove(model)
                elif len(writing) < threads and run.may_start(model) and not comes_first(model):
                    writing[run.write(model, pool)] = model
                    waiting.remove(model)
            if not (writing or checking):
                continue
            for done in wait([*writing, *checking], return_when=FIRST_COMPLETED).done:
                error = done.exception()
                if done in checking:
                    found = checking.pop(done)
                    for check in found:
                        run.checked_now.remove(check.model)
                    if error is None:
                        run.record(done.result())
                    for check in found if error is not None else ():
                        run.fail(check.model, error)
                    continue
                model = writing.pop(done)
                if error is not None:
                    run.fail(model, error)
                    continue
                stored, results = done.result()
                m.store(model, stored)
                run.report.built.append(model)
                run.ready.add(model)
                run.record(results)
            check_what_is_due()
    for group in (run.report.built, run.report.failed, run.report.skipped):
        group.sort(key=lambda name: list(PARENTS).index(name) if name in PARENTS else -1)
    return run.report


def finished(raw: Mapping[str, DataFrame], lake: Lake, params: Params | None = None) -> Models:
    """The models of a finished build, read from where it wrote them with the
    types they were made with: analyses of them rebuild nothing."""
    lazy = Models(raw, params)
    stored = {}
    for model in PARENTS:
        if layer_of(model) != "staging":
            made = getattr(lazy, model)
            stored[model] = stored_model(lazy.spark, lake, model, made.schema)
    return Models(raw, params, stored)


def stored_model(spark: SparkSession, lake: Lake, model: str, schema: StructType | None = None) -> DataFrame:
    """A model as a build last published it."""
    path, day = lake.path(layer_of(model), model), PARTITIONED.get(model, (None,))[0]
    nullable = None if schema is None else StructType([StructField(f.name, f.dataType, nullable=True) for f in schema.fields])
    return versions.read(spark, path, nullable, day)
