"""Data-quality checks that report counts instead of raising.

Every check yields one row: name, model, column, severity, failures, passed.
Row-level checks of a model share one aggregate over it, reference checks of
all models one search for parents; uniqueness and reference checks count per
key first, so a key that fills a third of the table is one row by the time it
is shuffled. Nulls fail only `not_null`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN, ERROR = "warn", "error"


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    columns: tuple[str, ...] = ()
    args: Any = None
    severity: str = ERROR

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def _violation(check: Check) -> Column | None:
    """Condition marking a failing row, for checks that look at single rows."""
    col = F.col(check.columns[0]) if check.columns else None
    match check.kind:
        case "not_null" | "expect_not_null":
            return col.isNull()
        case "accepted_values" | "expect_in_set":
            return ~col.isin(*check.args)
        case "expression_is_true":
            return ~F.expr(check.args)
        case "pair_a_at_least_b":
            return ~(col >= F.col(check.columns[1]))
        case "expect_between":
            low, high = check.args
            bad = F.lit(False)
            if low is not None:
                bad = bad | (col < F.lit(low))
            if high is not None:
                bad = bad | (col > F.lit(high))
            return bad
    return None


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.model).alias("model"),
        F.lit(check.label).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        (failures == 0).alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(complete).groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys with no parent and the number of rows that carry each."""
    carried = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias(key))
    return carried.join(known, key, "left_anti")


def lost_references(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row: per check, as column `lost_<place>`, the rows whose key its parent lacks.

    Every child is read once for all its keys, every parent once per key that is
    referred to. Keys are counted before they move, so that a hot one is a row
    per task, and the counts already lie as the search for parents needs them.
    """
    parents = list(dict.fromkeys(check.args for check in checks))
    of_child: dict[str, list[int]] = {}
    for place, check in enumerate(checks):
        of_child.setdefault(check.model, []).append(place)
    carried = []
    for model, places in of_child.items():
        keys = [
            F.struct(
                F.lit(parents.index(checks[place].args)).alias("parent"),
                F.col(checks[place].columns[0]).cast("string").alias("key"),
                F.lit(place).alias("place"),
            )
            for place in places
        ]
        carried.append(tables[model].select(F.inline(F.array(*keys))).where("key IS NOT NULL"))
    counted = reduce(DataFrame.unionAll, carried).groupBy("parent", "key").agg(
        *[F.count_if(F.col("place") == place).alias(f"lost_{place}") for place in range(len(checks))]
    )
    known = [
        tables[model].select(F.lit(number).alias("parent"), F.col(key).cast("string").alias("key"))
        for number, (model, key) in enumerate(parents)
    ]
    lost = counted.join(reduce(DataFrame.unionAll, known), ["parent", "key"], "left_anti")
    names = [f"lost_{place}" for place in range(len(checks))]
    return lost.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])


def failures(check: Check) -> Column | None:
    """Aggregate that counts what fails a check of single rows or of the row count; None for other checks."""
    if check.kind == "row_count_between":
        low, high = check.args
        return F.when(F.count("*").between(low, high), 0).otherwise(1)
    bad = _violation(check)
    return None if bad is None else F.count_if(bad)


def result_of(check: Check, failed: int) -> dict:
    """What `blocking(evaluate(...))` returns for a check, from a number of failures counted elsewhere."""
    return {
        "check_name": check.kind, "model": check.model, "column_name": check.label, "severity": check.severity,
        "failures": int(failed), "passed": failed == 0, "blocks": check.severity == ERROR and failed != 0,
    }


def _rows_of_model(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    results = [_result(check, failures(check)) for check in checks]
    return df.agg(F.array(*results).alias("results")).select(F.inline("results"))


def evaluate(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check. `tables` maps the model names checks refer to."""
    parts: list[DataFrame] = []
    row_level: dict[str, list[Check]] = {}
    references: list[Check] = []
    for check in checks:
        df = tables[check.model]
        match check.kind:
            case "unique" | "unique_combination":
                found = duplicate_keys(df, check.columns).agg(F.count("*").alias("n"))
            case "relationships":
                references.append(check)
                continue
            case "fewer_rows_than":
                mine = df.agg(F.count("*").alias("mine"))
                other = tables[check.args].agg(F.count("*").alias("other")).scalar()
                found = mine.select(F.when(F.col("mine") < other, 0).otherwise(1).alias("n"))
            case _:
                row_level.setdefault(check.model, []).append(check)
                continue
        parts.append(found.select(F.inline(F.array(_result(check, F.col("n"))))))
    if references:
        found = [_result(check, F.col(f"lost_{place}")) for place, check in enumerate(references)]
        parts.append(lost_references(tables, references).select(F.inline(F.array(*found))))
    parts += [_rows_of_model(tables[model], group) for model, group in row_level.items()]
    return reduce(DataFrame.unionAll, parts)


def blocking(results: DataFrame) -> DataFrame:
    """Failed checks that stop a build; warnings stay visible but do not."""
    return results.withColumn("blocks", (F.col("severity") == ERROR) & ~F.col("passed"))


def freshness(
    df: DataFrame,
    loaded_at: str,
    now: datetime,
    keys: Sequence[str] = (),
    warn_hours: int = 36,
    error_hours: int = 72,
) -> DataFrame:
    """Age of the newest row against a given moment, per key if any are given."""
    newest = df.groupBy(*keys).agg(F.max(loaded_at).cast("timestamp").alias("newest"))
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp")
    age = F.timestamp_diff("SECOND", F.col("newest"), moment) / F.lit(3600.0)
    status = (
        F.when(age.isNull() | (age > error_hours), ERROR).when(age > warn_hours, WARN).otherwise("pass")
    )
    return newest.select(*keys, F.round(age, 2).alias("age_hours"), status.alias("status"))
