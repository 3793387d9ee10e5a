"""Tables sorted so that a lookup by any of several keys reads few row groups.

Sorting by (a, b) scatters each value of b over the whole table. Here every key
is cut into ranges that hold about the same number of rows; the numbers of a
row's ranges are interleaved bit by bit, and rows are sorted by the result. A
file or row group then spans few ranges of each key, and Parquet's minimum and
maximum skip the others, whichever key is asked for.

Where the ranges end is taken from all rows: keys are counted, the counts
summed in the order of the key, and a range ends where a share of the rows is
reached. Only these ends, fewer than 2^bits for each key, come to the driver. A
key with a third of all rows is a range of its own, in which the other keys and
`spread` decide; ranges of rows are split by the range exchange.

Every key needs a pass over the rows, and so do the range exchange and the write.
What makes the rows, perhaps a join, runs once: they are written as they are
made, all passes read that copy, and it is deleted at the end.

Defined results: null keys lie in a key's first range; a table without rows
gives an empty table; rows are neither lost nor repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lake.operators.prefix import running_sums
from commerce_lake.sources import versions
from commerce_lake.sources.storage import shared_folder, write_table


def _copied(df: DataFrame) -> tuple[DataFrame, str]:
    """`df` as a written copy, and the folder that holds it."""
    spark, folder = df.sparkSession, f"{shared_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(StructType.fromJson(df.schema.jsonValue())).parquet(folder), folder


def range_ends(df: DataFrame, key: str, bits: int) -> list:
    """Smallest key of every range but the first, ascending; fewer than 2^bits."""
    counts, folder = _copied(df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        versions.delete(df.sparkSession, folder)
        return []
    upto = running_sums(counts, [F.col("key")], {"upto": "n"})
    versions.delete(df.sparkSession, folder)  # the sums are written
    # Rows before a key tell its range.
    share = F.floor((F.col("upto") - F.col("n")) / F.lit(total) * 2**bits)
    starts = upto.groupBy(share.alias("range")).agg(F.min("key").alias("key"))
    return sorted(r.key for r in starts.where("range > 0").select("key").collect())


def _range_of(key: Column, ends: Sequence) -> Column:
    """How many of the ends a key has reached, found by halving; none for null."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(key >= F.lit(ends[middle - 1]), among(middle, high)).otherwise(among(low, middle - 1))

    return among(0, len(ends))


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """One number from the bits of several, the highest of each first."""
    whole = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for number in numbers:
            whole = F.shiftleft(whole, 1).bitwiseOR(F.shiftright(number.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")))
    return whole


def write_zordered(
    df: DataFrame, path: str, keys: Sequence[str], spread: Sequence[str] = (), bits: int = 6, files: int | None = None,
    watch: Mapping[str, Column] | None = None, seen: dict | None = None,
) -> DataFrame:
    """Replace a table, its rows in interleaved order of the ranges of `keys`.

    `spread` names columns that separate rows of equal keys. `bits` a key give
    2^(bits * keys) cells; more of them than row groups help nobody.
    """
    rows, folder = _copied(df)
    place = interleaved([_range_of(F.col(k), range_ends(rows, k, bits)) for k in keys], bits)
    # Named for the sort only; a column of that name cannot be the table's own.
    name = "_cell"
    while name in df.columns:
        name += "_"
    celled, order = rows.withColumn(name, place), [name, *keys, *spread]
    dealt = celled.repartitionByRange(files, *order) if files else celled.repartitionByRange(*order)
    stored = write_table(dealt.sortWithinPartitions(*order).drop(name), path, watch, seen)
    versions.delete(df.sparkSession, folder)
    return stored
