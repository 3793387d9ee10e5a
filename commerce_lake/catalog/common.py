"""Shared pieces of the query catalogue."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from commerce_lake.bindings import TEST_PARAMS, BoundTables, raw_tables, read, state_regions
from commerce_lake.plans.marts import dim_date, spine_covering
from commerce_lake.plans.models import Models

Query = Callable[[SparkSession, str], DataFrame]


class BoundModels(Models):
    """Models over the bound test tables."""

    raw: BoundTables

    @cached_property
    def state_regions(self) -> DataFrame:
        return state_regions(self.raw.source("nation"), self.raw.source("region"))

    @cached_property
    def dim_date(self) -> DataFrame:
        # The calendar follows the orders it has to cover, so it grows with them.
        return dim_date(spine_covering(self.raw.source("orders"), "o_orderdate"), self.params)


def models(spark: SparkSession, sf_dir: str) -> BoundModels:
    return BoundModels(raw_tables(spark, sf_dir), TEST_PARAMS)


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, the form in which results are compared."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def over_models(build: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(models(spark, sf_dir)))


def over_tables(*names: str) -> Callable[[Callable[..., DataFrame]], Query]:
    """Decorator: pass the named test tables to the function as DataFrames."""

    def wrap(build: Callable[..., DataFrame]) -> Query:
        return lambda spark, sf_dir: plain(build(*[read(spark, sf_dir, n) for n in names]))

    return wrap


def with_views(views: dict[str, str], body: str) -> str:
    """Prefix a statement with the named subqueries it needs, transitively."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(views[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in needed) + "\n" + body


class Registry:
    """Collects queries over test tables together with their oracles."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, tables: str, sql: str):
        def wrap(build: Callable[..., DataFrame]):
            self.queries[name] = over_tables(*tables.split())(build)
            self.oracles[name] = sql
            return build

        return wrap
