"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered 0..N-1 in the order of (key, checksum, size, hash). A
balanced Feistel network permutes the smallest domain of 2^(2h) >= N numbers;
cycle walking repeats it until the image is below N, which makes it a
permutation of 0..N-1. Shard and slot follow from the image alone:
shard = image mod S, slot = image div S. Shard counts differ by one at most,
slots have no gaps, and where a row goes can be computed from its number
without any table.

Defined results: a null text has no bytes; rows with equal key and text are
interchangeable copies and get numbers of their own; a null key sorts first;
an empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from commerce_lake.llm.common import written

ROUNDS = 6


def half_bits(n: int) -> int:
    """Bits of one half of the smallest Feistel domain that holds n numbers."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def round_keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.RandomState(seed).randint(1, 2**31 - 1, ROUNDS)]


def _feistel(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for key in keys:
        mixed = (right + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
    return (left << np.uint64(bits)) | right


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Images of row numbers below n. Cycle walking takes under four steps on average."""
    bits, keys = half_bits(n), round_keys(seed)
    image = _feistel(numbers.astype(np.uint64), bits, keys)
    while (outside := image >= np.uint64(n)).any():
        image[outside] = _feistel(image[outside], bits, keys)
    return image.astype(np.int64)


def permuted(number: Column, n: int, seed: int) -> Column:
    @pandas_udf("long")
    def image(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    return image(number)


def numbered(df: DataFrame, order: list[str], number: str) -> DataFrame:
    """Consecutive row numbers in the order of the columns, without one task holding all.

    Range partitions are written once with the place of each row in its
    partition; the counts of the partitions, one row each, give their bases.
    A random last key only deals equal rows over partitions.
    """
    placed = (
        df.withColumn("_deal", F.rand(0))
        .repartitionByRange(*order, "_deal")
        .sortWithinPartitions(*order, "_deal")
        .drop("_deal")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    rows = written(placed, "numbered").withColumn("_part", F.shiftright("_place", 33))
    part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(part), F.lit(0)).alias("_base"))
    )
    place = F.col("_place") - F.shiftleft("_part", 33)
    # One row per partition: Spark broadcasts it by its size.
    return rows.join(bases, "_part").withColumn(number, F.col("_base") + place).drop("_part", "_place", "_base")


def assign(documents: DataFrame, shards: int, seed: int = 20) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = documents.select(
        "doc_id",
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_hash"),
    )
    rows = numbered(keys, ["doc_id", "text_crc32", "size", "_hash"], "_number").drop("_hash")
    image = rows.withColumn("_image", permuted(F.col("_number"), rows.count(), seed))
    return image.select(
        "doc_id", "size", "text_crc32",
        (F.col("_image") % shards).cast("int").alias("shard"),
        F.floor(F.col("_image") / F.lit(shards)).cast("long").alias("slot"),
    )
