"""Running sums over results of any length, without one task that holds them all."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lake.sources.storage import shared_folder


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """`df` with running sums, named by the keys, of the columns they stand for.

    Two passes: rows are dealt by range into partitions, written with the number
    of their partition, and every partition is summed; what lies before a
    partition, one row each, is then added to the sums inside it. `order` must
    tell all rows apart. Nulls add nothing; a sum is null up to the first value.
    The rows are written because both passes must see the same partitions.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/running-{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(StructType.fromJson(dealt.schema.jsonValue())).parquet(path)

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_part").agg(*[F.sum(c).alias(f"_total_{k}") for k, c in enumerate(sums.values())])
    offsets = totals.select("_part", *[F.sum(f"_total_{k}").over(before).alias(f"_before_{k}") for k in range(len(sums))])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(offsets, "_part")  # one row per partition
    added = []
    for k, (name, column) in enumerate(sums.items()):
        here, earlier = F.sum(column).over(inside), F.col(f"_before_{k}")
        added.append(F.coalesce(here + earlier, here, earlier).alias(name))
    return placed.select(*df.columns, *added)
