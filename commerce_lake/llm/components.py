"""Connected components by alternating large-star and small-star steps.

Every step is an aggregate and a join over edges, so a node with very many
neighbours is never gathered: its smallest neighbour is a partial minimum, and
the join's partition of that node is split by adaptive execution. Edges are
written after each round, which keeps lineage short. Rounds grow with the
logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of u to the smallest of u and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the smallest of them. Edges lead from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in an edge of `edges` (u, v): component is
    the smallest node that can be reached, and no row for a node that is its own."""
    current = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges"
    )
    mark = None
    while True:
        # As many edges with the same sum of hashes: the last round changed nothing.
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
        current = written(_small_star(_large_star(current)), "edges")
