"""Everything a snapshot does against its contract, as a table.

A strict read stops at the first offence. `findings` reads what it would refuse
and lists it: parts whose header is not the declared one, rows with another
number of cells, cells that are not of their type. Nothing is loaded by it, and
a snapshot with findings is refused by `land` and `load` as before; without
findings it is accepted.

Rows are judged by the same parser as in a strict read, in one scan; a second,
narrow one finds each part's first line. Rows of a part with another header are
not judged, for their cells have no sure names.

Defined results: a table without a file, or without rows, has one finding or
none; blank cells are nulls of any type; a record that fails for several cells
gives one row for each; a clean snapshot gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from commerce_lake.sources.contract import csv_options, exists, location
from commerce_lake.sources.schema import RAW_TABLES, RawTable

FINDING = "table string, file string, problem string, column string, value string, record string"
NO_FILE, HEADER, CELLS, TYPE = "no file", "header", "number of cells", "type"
_RECORD = "_refused_record"


def _first_lines(spark: SparkSession, prefix: str, table: RawTable) -> DataFrame:
    """(file, line): the header of every part, one row per part and task.

    Lines of a split follow each other within a task, so the smallest number of
    the split that starts a file marks its first line."""
    lines = spark.read.text(location(prefix, table)).select(
        F.col("_metadata.file_name").alias("file"), "value",
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("at"),
    )
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))


def _header_findings(spark: SparkSession, prefix: str, table: RawTable) -> DataFrame:
    names = [c for c, _ in table.columns]
    # A name that itself holds a comma is no declared one, and comes out in pieces.
    found = F.transform(F.split("line", ","), lambda c: F.regexp_extract(c, r'^\s*"?(.*?)"?\s*$', 1))
    parts = _first_lines(spark, prefix, table).withColumn("found", found)
    extra = F.array_except("found", F.array(*map(F.lit, names)))
    lacking = F.array_except(F.array(*map(F.lit, names)), "found")
    other = parts.where(F.col("found") != F.array(*map(F.lit, names)))
    said = F.when(F.size(extra) > 0, F.array_join(extra, ",")).when(F.size(lacking) > 0, F.array_join(lacking, ","))
    kind = F.when(F.size(extra) > 0, "undeclared columns").when(F.size(lacking) > 0, "missing columns").otherwise("order of columns")
    return other.select(
        F.lit(table.name).alias("table"), "file", F.concat(F.lit(HEADER + ": "), kind).alias("problem"), said.alias("column"),
        F.lit(None).cast("string").alias("value"), F.col("line").alias("record"),
    )


def _record_findings(spark: SparkSession, prefix: str, table: RawTable) -> DataFrame:
    """What the typed parser refused, taken apart into cells to name the columns."""
    schema = StructType([*table.schema.fields, StructField(_RECORD, StringType())])
    rows = (
        spark.read.schema(schema).options(**csv_options(table))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, columnPruning="false")
        .csv(location(prefix, table))
        .select("*", F.col("_metadata.file_name").alias("_file"))
    )
    names = [c for c, _ in table.columns]
    quoting = {k: v for k, v in csv_options(table).items() if k in ("quote", "escape", "multiLine")}
    as_text = ", ".join(f"`{c}` string" for c in names)
    refused = rows.where(F.col(_RECORD).isNotNull()).withColumn("_cells", F.from_csv(_RECORD, F.lit(as_text), quoting))
    named = [
        F.when(F.col(c).isNull() & F.col("_cells")[c].isNotNull(), F.struct(F.lit(c).alias("column"), F.col("_cells")[c].alias("value")))
        for c in names
    ]
    wrong = F.filter(F.array(*named), lambda cell: cell.isNotNull())
    none = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value")))
    each = refused.withColumn("_wrong", wrong).select(
        "_file", _RECORD, F.when(F.size("_wrong") > 0, TYPE).otherwise(CELLS).alias("problem"),
        F.explode(F.when(F.size("_wrong") > 0, F.col("_wrong")).otherwise(none)).alias("cell"),
    )
    return each.select(
        F.lit(table.name).alias("table"), F.col("_file").alias("file"), "problem", "cell.column", "cell.value", F.col(_RECORD).alias("record")
    )


def findings(spark: SparkSession, prefix: str, tables: Mapping[str, RawTable] = RAW_TABLES) -> DataFrame:
    """One row per offence: (table, file, problem, column, value, record)."""
    parts = []
    for table in tables.values():
        if not exists(spark, location(prefix, table)):
            absent = [(table.name, table.file, NO_FILE, None, None, None)]
            parts.append(spark.createDataFrame(absent, FINDING))
            continue
        headers = _header_findings(spark, prefix, table)
        records = _record_findings(spark, prefix, table)
        parts += [headers, records.join(headers.select("file"), "file", "left_anti").select(*headers.columns)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], FINDING)
