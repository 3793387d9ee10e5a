"""CSV scans under a frozen contract."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from commerce_lake.sources.schema import RAW_TABLES, RawTable


class ContractError(ValueError):
    """A file that does not match its declaration."""


def csv_options(table: RawTable) -> dict[str, str]:
    # Only free text may hold line breaks. Everything else stays splittable, so
    # one very large file is still read by many tasks.
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "multiLine": str(table.free_text).lower(),
    }


def location(prefix: str, table: RawTable) -> str:
    return f"{prefix.rstrip('/')}/{table.file}"


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def missing_files(spark: SparkSession, prefix: str, tables: Mapping[str, RawTable] = RAW_TABLES) -> list[str]:
    return sorted(t.file for t in tables.values() if not exists(spark, location(prefix, t)))


def header_of(spark: SparkSession, prefix: str, table: RawTable) -> list[str]:
    """Column names as written in the part that is first by name; reads its first line only."""
    parts = spark.read.format("binaryFile").load(location(prefix, table))
    first = parts.agg(F.min("path")).first()[0]  # of a listing: no content is read
    return spark.read.options(**csv_options(table)).csv(first).columns if first else []


def check_header(spark: SparkSession, prefix: str, table: RawTable) -> None:
    found, declared = header_of(spark, prefix, table), [c for c, _ in table.columns]
    for names, problem in (
        ([c for c in found if c not in declared], "undeclared column(s)"),
        ([c for c in declared if c not in found], "missing column(s)"),
    ):
        if names:
            raise ContractError(f"{table.file}: {problem} {', '.join(names)}")
    if found != declared:
        raise ContractError(f"{table.file}: columns are not in the declared order")


def _strict(spark: SparkSession, prefix: str, table: RawTable, schema: StructType) -> DataFrame:
    """Every part has exactly these columns in this order, every row as many
    cells, every value its type; the first offence fails the read. A condition
    on all columns, which always holds, has them read whichever are used later."""
    rows = (
        spark.read.schema(schema)
        .options(**csv_options(table))
        .options(enforceSchema="false", mode="FAILFAST", columnPruning="false")
        .csv(location(prefix, table))
    )
    return rows.where(F.hash(*schema.names) >= F.lit(-(2**31)))


def scan(spark: SparkSession, prefix: str, table: RawTable) -> DataFrame:
    """Read a raw file, or folder of part files, with its declared types.

    One part's header is compared with the declaration at once, that of every
    other part by the task that reads it. A row with more or fewer cells, or a
    value of the wrong type in any column, fails the read; blank values are
    nulls of the declared type.
    """
    check_header(spark, prefix, table)
    return _strict(spark, prefix, table, table.schema)


def scan_as_text(spark: SparkSession, prefix: str, table: RawTable) -> DataFrame:
    """Read whatever columns the files have, untyped, for the landing snapshot.

    All parts must have the same columns, or cells would land under wrong names.
    """
    found = StructType([StructField(c, StringType()) for c in header_of(spark, prefix, table)])
    return _strict(spark, prefix, table, found)


_HEADER = re.compile(r"Expected: (\S+) but found: (\S+)\s+CSV file: (\S+)")
_HEADER_LENGTH = re.compile(r"Header length: (\d+), schema size: (\d+)\s+CSV file: (\S+)")


@contextmanager
def refusing(table: RawTable) -> Iterator[None]:
    """Turn a failed strict read into a ContractError that names file and column."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        text = str(error)
        if named := _HEADER.search(text):
            detail = f"expects column {named[1]}, found {named[2]} in {named[3]}"
        elif sized := _HEADER_LENGTH.search(text):
            detail = f"expects {sized[2]} columns, found {sized[1]} in {sized[3]}"
        elif "MALFORMED_RECORD" in text or "MALFORMED_CSV_RECORD" in text:
            parsed = re.search(r"[Mm]alformed [^\n]*", text)
            detail = parsed[0] if parsed else "malformed record"
        else:
            raise
        raise ContractError(f"{table.file}: {detail}") from error


def scan_all(
    spark: SparkSession, prefix: str, tables: Mapping[str, RawTable] = RAW_TABLES
) -> dict[str, DataFrame]:
    """All declared tables; files that are not declared are ignored."""
    absent = missing_files(spark, prefix, tables)
    if absent:
        raise FileNotFoundError(f"{prefix} lacks: {', '.join(absent)}")
    return {name: scan(spark, prefix, table) for name, table in tables.items()}
