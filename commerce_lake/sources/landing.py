"""Dated raw snapshots and the loads made from them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.operators.checks import freshness
from commerce_lake.sources.contract import location, missing_files, refusing, scan_all, scan_as_text
from commerce_lake.sources.schema import RAW_TABLES, RawTable


def land(
    spark: SparkSession,
    incoming: str,
    zone: str,
    ingest_date: date,
    landed_at: datetime,
    tables: Mapping[str, RawTable] = RAW_TABLES,
) -> str:
    """Copy the expected files under a dated prefix and log the landing.

    Cells are copied as text with whatever columns the files have, as long as
    all parts of a table have the same; the contract is applied when the
    snapshot is loaded. Free text, which one task per file must read, lands in
    parts of even size, so the load reads it with many. Every landing has a
    folder of its own and is logged last: a refused one changes nothing, a
    repeated date is replaced for those who ask for the date, and who reads the
    earlier landing of that date goes on reading it.
    """
    absent = missing_files(spark, incoming, tables)
    if absent:
        raise FileNotFoundError(f"{incoming} lacks: {', '.join(absent)}")
    prefix = f"{zone.rstrip('/')}/{ingest_date.isoformat()}/{uuid.uuid4().hex}"
    for table in tables.values():
        cells = scan_as_text(spark, incoming, table)
        if table.free_text:
            cells = cells.hint("rebalance")
        with refusing(table):
            cells.write.options(
                header="true", quoteAll="true", escape='"',
                ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
            ).csv(location(prefix, table))
    entry = [(ingest_date, landed_at, len(tables), prefix, datetime.now(timezone.utc))]
    log = spark.createDataFrame(
        entry, "ingest_date date, landed_at timestamp, files int, prefix string, logged_at timestamp"
    )
    log.write.mode("append").parquet(f"{zone.rstrip('/')}/_landings")
    return prefix


def _newest(spark: SparkSession, zone: str, ingest_date: date | None) -> str:
    try:
        log = spark.read.parquet(f"{zone.rstrip('/')}/_landings")
    except AnalysisException as error:
        raise LookupError(f"nothing has been landed in {zone}") from error
    asked = log if ingest_date is None else log.where(F.col("ingest_date") == F.lit(ingest_date))
    newest = asked.agg(F.max_by("prefix", F.struct("landed_at", "logged_at"))).first()[0]
    if newest is None:
        raise LookupError(f"nothing has been landed in {zone} on {ingest_date}")
    return newest


def latest_prefix(spark: SparkSession, zone: str) -> str:
    """Prefix of the most recent landing."""
    return _newest(spark, zone, None)


def prefix_on(spark: SparkSession, zone: str, ingest_date: date) -> str:
    """Prefix of the most recent landing of a date."""
    return _newest(spark, zone, ingest_date)


def load(
    spark: SparkSession,
    prefix: str,
    target: str,
    load_id: str,
    loaded_at: datetime,
    tables: Mapping[str, RawTable] = RAW_TABLES,
) -> dict[str, DataFrame]:
    """Replace the raw tables by a snapshot, every row marked with its load.

    Each load has a folder of its own and is logged when every table is in
    place; readers follow the log. A load that fails leaves the one before it
    as it was.
    """
    scanned = scan_all(spark, prefix, tables)
    number = 1 + max((r.number for r in _logged(spark, target)), default=0)
    folder = f"{target.rstrip('/')}/load-{number:06d}-{uuid.uuid4().hex}"
    for name, df in scanned.items():
        marked = df.withColumns(
            {"load_id": F.lit(load_id), "loaded_at": F.lit(loaded_at).cast("timestamp")}
        )
        with refusing(tables[name]):
            marked.write.parquet(f"{folder}/{name}")
    entry = [(number, load_id, prefix, folder, loaded_at, len(scanned), datetime.now(timezone.utc))]
    log = spark.createDataFrame(
        entry,
        "number int, load_id string, prefix string, folder string, loaded_at timestamp, tables int, logged_at timestamp",
    )
    log.write.mode("append").parquet(f"{target.rstrip('/')}/_loads")
    return read_raw(spark, target, tables)


def _logged(spark: SparkSession, target: str) -> list:
    """Log entries, one per load."""
    try:
        return loads(spark, target).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_raw(
    spark: SparkSession, target: str, tables: Mapping[str, RawTable] = RAW_TABLES
) -> dict[str, DataFrame]:
    """The raw tables of the last finished load."""
    log = _logged(spark, target)
    if not log:
        raise LookupError(f"nothing has been loaded into {target}")
    folder = max(log, key=lambda r: (r.number, r.logged_at)).folder  # loads at once share a number
    return {name: spark.read.parquet(f"{folder}/{name}") for name in tables}


def loads(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target.rstrip('/')}/_loads")


def load_freshness(spark: SparkSession, target: str, now: datetime) -> DataFrame:
    """Age and status of the last load."""
    return freshness(loads(spark, target), "loaded_at", now)
