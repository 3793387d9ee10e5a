"""What the vector operators agree on: which vectors take part and how many components they have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, ok)


def common_size(rows: DataFrame, vector: str) -> int:
    """The commonest number of components, the larger of equally common ones; 0 for an empty table."""
    sizes = rows.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    top = sizes.agg(F.max(F.struct("n", "size")).alias("top")).first()["top"]
    return top["size"] if top else 0
