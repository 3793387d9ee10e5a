"""Where tables live and how they are laid out when written."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lake.sources import versions


DAY_PARTITIONS = 1000


@dataclass(frozen=True)
class Lake:
    """Base folder and target name; dev, ci and prod never share a table."""

    base: str
    target: str = "dev"

    def path(self, layer: str, table: str = "") -> str:
        return "/".join(p for p in (self.base.rstrip("/"), self.target, layer, table) if p)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in
    `spark.checkpoint.dir`.

    Only a session of one process (`local[...]`), where it is the same disk for
    all, may leave it unset and gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise LookupError("spark.checkpoint.dir must name a folder shared by the cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lake-")


def _nullable(schema: StructType) -> StructType:
    copy = StructType.fromJson(schema.jsonValue())
    for field in copy.fields:
        field.nullable = True
    return copy


def _published(df: DataFrame, path: str, day: str | None = None) -> DataFrame:
    """Read back with the types it was made with."""
    return versions.read(df.sparkSession, path, _nullable(df.schema), day)


def observed(df: DataFrame, watch: Mapping[str, Column] | None) -> tuple[DataFrame, Observation | None]:
    """`df` with aggregates that its next action computes on the way."""
    if not watch:
        return df, None
    watching = Observation()
    return df.observe(watching, *[value.alias(name) for name, value in watch.items()]), watching


def write_table(df: DataFrame, path: str, watch: Mapping[str, Column] | None = None, seen: dict | None = None) -> DataFrame:
    """Replace a table; running twice leaves one copy, and readers see the one
    before until the new one is whole. `watch` names aggregates to compute in
    the pass that writes; their values go to `seen`."""
    return _written(df, path, lambda rows, folder: rows.write.parquet(folder), watch, seen)


def _written(
    df: DataFrame, path: str, write: Callable[[DataFrame, str], None], watch: Mapping[str, Column] | None, seen: dict | None,
    day: str | None = None,
) -> DataFrame:
    # Watched last, above any exchange: a range exchange runs what is below it twice.
    rows, watching = observed(df, watch)
    versions.publish(df.sparkSession, path, lambda folder: write(rows, folder))
    if watching is not None and seen is not None:
        seen.update(watching.get)
    return _published(df, path, day)


def _by_day(df: DataFrame, day: str, cluster: Sequence[str]) -> DataFrame:
    """Gather each day and sort it by the cluster columns.

    The rebalance hint costs one shuffle and no sampling pass. Adaptive
    execution then splits a day that holds much of the table over many tasks
    and lets one task write several small days. It starts from many partitions,
    so that one which is split holds few days: each part of it writes a file a day.
    """
    return df.hint("rebalance", DAY_PARTITIONS, F.col(day)).sortWithinPartitions(day, *cluster)


def write_partitioned(
    df: DataFrame, path: str, day: str, cluster: Sequence[str],
    watch: Mapping[str, Column] | None = None, seen: dict | None = None,
) -> DataFrame:
    """One directory per day, rows sorted by the cluster columns inside, which
    gives Parquet tight minimum and maximum values per row group."""
    write = lambda rows, folder: rows.write.partitionBy(day).parquet(folder)
    return _written(_by_day(df, day, cluster), path, write, watch, seen, day)


def replace_days(df: DataFrame, path: str, day: str, cluster: Sequence[str], days: Sequence[str | None] | None = None) -> DataFrame:
    """Replace the days present in `df` (or the given ones); other days stay as they are, and where they are."""
    spark, folder = df.sparkSession, versions.new_folder(path)
    _by_day(df, day, cluster).write.partitionBy(day).parquet(folder)
    if days is None:
        made = spark.read.schema(_nullable(df.schema)).parquet(folder)
        days = [r.day for r in made.select(F.col(day).cast("string").alias("day")).distinct().collect()]
    versions.log(spark, path, folder, days)
    return _published(df, path, day)


def refresh_days(df: DataFrame, path: str, day: str, cluster: Sequence[str]) -> list[str | None]:
    """Bring a table of days to the rows of `df`, writing only days that differ.

    Digests of the days are kept beside the table; those of `df` take one pass
    and a row per day. Returns the days that were written or removed.
    """
    spark, digests = df.sparkSession, f"{path.rstrip('/')}/_digests"
    new = versions.day_digests(df, day)
    folder = versions.publish(spark, digests + "-next", new.write.parquet)
    new = spark.read.schema(versions.DIGESTS).parquet(folder)
    try:
        old = versions.read(spark, digests, StructType.fromDDL(versions.DIGESTS))
    except LookupError:
        write_partitioned(df, path, day, cluster)
        versions.log(spark, digests, folder)
        return [r.day for r in new.select("day").collect()]
    days = versions.changed_days(old, new)
    if days:
        replace_days(df.where(versions.is_one_of(F.col(day), set(days))), path, day, cluster, days)
        versions.log(spark, digests, folder)
    return days


def write_clustered(
    df: DataFrame, path: str, keys: Sequence[str], watch: Mapping[str, Column] | None = None, seen: dict | None = None
) -> DataFrame:
    """Range-split and sorted on `keys`, so that a lookup reads few row groups.

    `keys` should end in a column that separates rows of one large key.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return write_table(ordered, path, watch, seen)


def publish(df: DataFrame, path: str, allow_replace: bool = False) -> bool:
    """Replace a shared table only when asked to; says whether it did."""
    if allow_replace:
        write_table(df, path)
    return allow_replace


def to_client(df: DataFrame, max_rows: int):
    """Bring a small result to the client; a larger one is an error."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate it first")
    return rows


def write_json_records(df: DataFrame, path: str) -> None:
    typed = df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    typed.write.mode("overwrite").json(path)
