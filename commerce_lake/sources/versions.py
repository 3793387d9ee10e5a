"""Tables as immutable version folders behind a log.

A write goes to a folder of its own, whose name nobody can guess, and is logged
when every file is in place. Readers follow the log, so they see the old state
until that one append, and a write that fails changes nothing. A version holds
the whole table or, for a table of days, only the days it replaces; reading
takes every day from the newest version that names it, which partition pruning
keeps to listing. `prune` deletes what no kept state needs any more.

Defined results: a table that was never published raises LookupError; rows of a
null day form a day of their own; a replaced day without rows is gone; writers
at the same time both succeed and the later logged one is what readers see.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG = "_versions"
ENTRY = "folder string, whole boolean, days array<string>, logged_at timestamp"


@dataclass(frozen=True)
class Version:
    folder: str
    whole: bool
    days: tuple[str | None, ...]  # replaced by this version, unless it is whole
    logged_at: datetime


def new_folder(path: str) -> str:
    return f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"


def log(spark: SparkSession, path: str, folder: str, days: Sequence[str | None] | None = None) -> None:
    """Make a finished folder what readers see: the whole table, or these days of it."""
    named = F.array(*[F.lit(d).cast("string") for d in days or ()]).cast("array<string>")
    entry = spark.range(0, 1, 1, 1).select(
        F.lit(folder).alias("folder"), F.lit(days is None).alias("whole"), named.alias("days"),
        F.lit(datetime.now(timezone.utc)).alias("logged_at"),
    )
    entry.write.mode("append").parquet(f"{path.rstrip('/')}/{LOG}")


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Logged versions, oldest first; one row each."""
    try:
        rows = spark.read.schema(ENTRY).parquet(f"{path.rstrip('/')}/{LOG}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [Version(r.folder, r.whole, tuple(r.days), r.logged_at) for r in rows]
    return sorted(found, key=lambda v: (v.logged_at, v.folder))


def _needed(found: Sequence[Version]) -> list[Version]:
    """The last whole version and those after it."""
    first = max((k for k, v in enumerate(found) if v.whole), default=None)
    return [] if first is None else list(found[first:])


def is_one_of(day: Column, days: set[str | None]) -> Column:
    """Whether a day, as text, is among the given ones; null is a day like others."""
    named = [F.lit(d) for d in sorted(d for d in days if d is not None)]
    same = day.cast("string").isin(*named) if named else F.lit(False)
    return F.coalesce(same, F.lit(False)) | (day.isNull() if None in days else F.lit(False))


def read(spark: SparkSession, path: str, schema: StructType | None = None, day: str | None = None, back: int = 0) -> DataFrame:
    """The table as last published, or as it was `back` versions before.

    `schema` gives the types it was written with: a partition value is not
    guessed. Only tables with replaced days need `day`, their partition column.
    """
    found = versions(spark, path)
    chain = _needed(found[: len(found) - back])
    if not chain:
        raise LookupError(f"nothing has been published at {path}")
    parts, replaced = [], set()
    for version in reversed(chain):
        reader = spark.read if schema is None else spark.read.schema(schema)
        part = reader.parquet(version.folder)
        parts.append(part.where(~is_one_of(F.col(day), replaced)) if replaced else part)
        replaced |= set(version.days)
    whole = parts[0] if schema is None else parts[0].select(*schema.names)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*whole.columns))
    return whole


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Have `write` fill a new folder with the whole table, then switch to it."""
    folder = new_folder(path)
    write(folder)
    log(spark, path, folder)
    return folder


def delete(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def prune(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete folders that none of the last `keep` states needs; returns them."""
    found = versions(spark, path)
    needed = {v.folder for back in range(max(keep, 1)) for v in _needed(found[: len(found) - back])}
    gone = [v.folder for v in found if v.folder not in needed]
    for folder in gone:
        delete(spark, folder)
    return gone


# Which days changed ------------------------------------------------------

DIGESTS = "day string, n long, total decimal(38,0), parity long"


def day_digests(df: DataFrame, day: str) -> DataFrame:
    """(day, n, total, parity): the same for the same rows of a day in any order.

    A sum of row hashes alone would miss rows swapped for others of the same
    sum, a parity alone a row that comes twice more; together with the count a
    change goes unseen with probability 2^-64 or so.
    """
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.groupBy(F.col(day).cast("string").alias("day")).agg(
        F.count("*").alias("n"), F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"), F.bit_xor(row).alias("parity")
    )


def changed_days(old: DataFrame, new: DataFrame) -> list[str | None]:
    """Days whose digests differ, or that only one side has; one row per changed day."""
    both = old.withColumnsRenamed({"n": "_n", "total": "_total", "parity": "_parity", "day": "_day"}).join(
        new, F.col("_day").eqNullSafe(F.col("day")), "full"
    )
    same = F.col("_n").eqNullSafe(F.col("n")) & F.col("_total").eqNullSafe(F.col("total")) & F.col("_parity").eqNullSafe(F.col("parity"))
    rows = both.where(~same).select(F.when(F.col("n").isNull(), F.col("_day")).otherwise(F.col("day")).alias("day"))
    return sorted((r.day for r in rows.collect()), key=lambda d: (d is not None, d))
