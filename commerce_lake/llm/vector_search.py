"""Nearest neighbours by largest inner product: probed lists and an adaptive dimension scan.

Equal vectors are one class with its smallest ids, as many as a result can
show, so a vector that fills the table is one candidate. Vectors are divided by
the largest norm and get one more component that makes all of them unit
vectors; queries get a zero there. Nearest by inner product is then nearest by
distance. A fixed random rotation spreads a distance evenly over components,
and the index stores rotated vectors as column blocks, one column each, by list.

Lists are the cells of centroids fitted on a bounded sample; every class is in
one. How many lists a query probes is measured: a sample of the queries is
answered by brute force over the whole index, and the least number of lists
that hold the wanted share of these answers is taken for all.

Within a list, queries meet candidates in blocks of bounded size. The distance
grows column block by column block. If the true distance were within a query's
bound, the share of it seen so far would follow a beta distribution; candidates
whose partial distance is beyond its upper quantile are abandoned. The bound
comes from the query's nearest list, which is scanned first, and there from the
first candidates. What survives all blocks is scored on the original vectors in
double precision.

Defined results: rows of a null key, and vectors that are null, empty, zero,
of other than the commonest length, or hold null or non-finite components,
take no part. Keys are integers; rows of one key are candidates each, and a
query leaves out one row of its own key and vector. Ties go to the smaller key.
Fewer candidates than wanted are all returned, if they lie in probed lists; an
empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import written
from commerce_lake.llm.vectors import common_size, finite


@dataclass(frozen=True)
class Plan:
    nearest: int = 20
    most_lists: int = 4096
    per_list: int = 32  # sampled vectors a list is fitted on
    fits: int = 8
    asked: int = 256  # sampled queries the number of probes is measured on
    recall: float = 0.97  # share of their answers that the probed lists hold
    width: int = 16  # largest column block
    error: float = 0.001  # chance that one test abandons a true neighbour
    queries: int = 512  # in a block
    candidates: int = 2048  # in a block
    seed: int = 13


#: How far single-precision distances between unit vectors are trusted.
SLACK = 1e-5


def beta_quantile(a: float, b: float, share: float) -> float:
    """Value below which lies `share` of a beta distribution."""
    x = (np.arange(200_000) + 0.5) / 200_000
    density = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    total = np.cumsum(np.exp(density - density.max()))
    return float(x[np.searchsorted(total, share * total[-1])])


class Space:
    """Unit vectors in rotated coordinates, cut into column blocks."""

    def __init__(self, size: int, largest: float, plan: Plan) -> None:
        normal = np.random.RandomState(plan.seed).standard_normal((size + 1, size + 1))
        self.rotation = np.linalg.qr(normal)[0]
        self.largest = largest
        cuts = [c[0] for c in np.array_split(np.arange(size + 1), -(-(size + 1) // plan.width))] + [size + 1]
        self.blocks = list(zip(cuts[:-1], cuts[1:], strict=True))
        #: The least distance, as a multiple of the bound, that a block's test abandons.
        self.beyond = [beta_quantile(end / 2, (size + 1 - end) / 2, 1 - plan.error) for _, end in self.blocks[:-1]] + [1.0]

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.largest
        rest = np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
        return (np.c_[scaled, rest] @ self.rotation).astype(np.float32)

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]
        return (unit @ self.rotation[:-1]).astype(np.float32)

    def distance(self, score: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Squared distances of unit vectors for inner products with the given queries."""
        return 2 - 2 * score / (np.sqrt((vectors**2).sum(axis=1)) * self.largest)


def fitted(sample: np.ndarray, lists: int, plan: Plan) -> np.ndarray:
    """Centroids of a sample of placed vectors."""
    state = np.random.RandomState(plan.seed)
    centroids = sample[state.permutation(len(sample))[:lists]].copy()
    for _ in range(plan.fits):
        cell = cells(sample, centroids)
        order = np.argsort(cell, kind="stable")
        used, first = np.unique(cell[order], return_index=True)
        n = np.diff(np.r_[first, len(sample)])
        centroids[used] = np.add.reduceat(sample[order], first, axis=0) / n[:, None]
    return centroids


def _away(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (centroids**2).sum(axis=1) - 2 * (vectors @ centroids.T)


def cells(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = 4096
    parts = [_away(vectors[i : i + step], centroids).argmin(axis=1) for i in range(0, len(vectors), step)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int, kind: type) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, size)


def _listed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def classes_of(rows: DataFrame, asks: Column, plan: Plan, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(node, ids, vector) of distinct vectors with their smallest ids, and (node, query_id) of the queries."""
    cast = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), asks.alias("asks"))
    some = cast.filter(F.col("id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    size = common_size(some, "vector")
    some = some.filter(F.size("vector") == size)
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = some.select("id", "vector", place.alias("place")).filter(F.col("place") <= plan.nearest + 1)
    grouped = first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = written(grouped.select(F.monotonically_increasing_id().alias("node"), "ids", "vector"), "vector-classes")
    asked = some.filter("asks").select(F.col("id").alias("query_id"), "vector")
    return classes, written(asked.join(classes.select("node", "vector"), "vector").select("node", "query_id"), "vector-queries")


def indexed(classes: DataFrame, space: Space, centroids: np.ndarray) -> DataFrame:
    """Classes with their list and the column blocks of their rotated vectors."""
    size = len(space.rotation) - 1
    blocks = "".join(f", block{k} array<float>" for k in range(len(space.blocks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            placed = space.placed(_matrix(batch.column("vector"), size, np.float64))
            columns = [pa.array(cells(placed, centroids).astype(np.int32)), *[_listed(placed[:, a:b]) for a, b in space.blocks]]
            names = ["list", *[f"block{k}" for k in range(len(space.blocks))]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return classes.mapInArrow(run, f"node long, ids array<long>, vector array<float>, list int{blocks}")


def probes_needed(index: DataFrame, sample: np.ndarray, space: Space, centroids: np.ndarray, plan: Plan) -> int:
    """The least number of lists that hold the wanted share of the sampled queries' true answers."""
    size = len(space.rotation) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, cell = np.full((len(sample), plan.nearest), -np.inf), np.zeros((len(sample), plan.nearest), np.int64)
        for batch in batches:
            score = np.c_[best, sample @ _matrix(batch.column("vector"), size, np.float64).T]
            lists = np.broadcast_to(batch.column("list").to_numpy(), (len(sample), batch.num_rows))
            lists = np.c_[cell, lists]
            top = np.argpartition(-score, plan.nearest - 1, axis=1)[:, : plan.nearest]
            best, cell = np.take_along_axis(score, top, 1), np.take_along_axis(lists, top, 1)
        asker, _ = np.nonzero(np.isfinite(best))
        found = np.isfinite(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(asker.astype(np.int32)), pa.array(best[found]), pa.array(cell[found].astype(np.int32))],
            names=["asker", "score", "list"],
        )

    found = index.select("vector", "list").mapInArrow(run, "asker int, score double, list int")
    place = F.row_number().over(Window.partitionBy("asker").orderBy(F.col("score").desc(), "list"))
    top = found.withColumn("place", place).filter(F.col("place") <= plan.nearest).select("asker", "list").toArrow()
    order = _away(space.asked(sample), centroids).argsort(axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centroids))[None], axis=1)
    ranks = np.sort(rank[top.column("asker").to_numpy(), top.column("list").to_numpy()])
    return int(ranks[int(np.ceil(plan.recall * len(ranks))) - 1]) + 1 if len(ranks) else len(centroids)


def probing(queries: DataFrame, space: Space, centroids: np.ndarray, probes: int) -> DataFrame:
    """(node, vector, list, turn) of the lists each query probes, nearest first."""
    size = len(space.rotation) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = space.asked(_matrix(batch.column("vector"), size, np.float64))
            lists = _away(asked, centroids).argsort(axis=1, kind="stable")[:, :probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, _listed(lists)], names=[*batch.schema.names, "lists"])

    near = queries.select("node", "vector").mapInArrow(run, "node long, vector array<float>, lists array<int>")
    return near.select("node", "vector", F.posexplode("lists").alias("turn", "list"))


FOUND = "node long, vec_id long, score double, own boolean"


def _scanned(asked: np.ndarray, blocks: list[np.ndarray], bound: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, candidate, distance) that no test has abandoned, by squared distances within `bound`."""
    i = j = None  # all pairs, as a matrix of partial distances, until few are left
    partial = np.zeros((len(asked), len(blocks[0])), np.float32)
    for (start, end), block, beyond in zip(space.blocks, blocks, space.beyond, strict=True):
        query = asked[:, start:end]
        if i is None:
            partial += (query**2).sum(axis=1)[:, None] + (block**2).sum(axis=1) - 2 * (query @ block.T)
            live = partial <= (bound * beyond + SLACK)[:, None]
            if 5 * np.count_nonzero(live) <= live.size:
                i, j = np.nonzero(live)
                partial = partial[i, j]
        else:
            partial = partial + ((query[i] - block[j]) ** 2).sum(axis=1)
            live = partial <= bound[i] * beyond + SLACK
            i, j, partial = i[live], j[live], partial[live]
    if i is None:
        i, j = np.nonzero(live)
        partial = partial[i, j]
    return i, j, partial


def scan(space: Space, plan: Plan):
    """Best candidates of a block for the queries of a block."""
    size, wanted = len(space.rotation) - 1, plan.nearest + 1
    schema = pa.schema([("node", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("own", pa.bool_())])

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        askers, nodes = (t.column("node").to_numpy() for t in (queries, candidates))
        vectors, others = (_matrix(t.column("vector"), size, np.float64) for t in (queries, candidates))
        blocks = [_matrix(candidates.column(f"block{k}"), b - a, np.float32) for k, (a, b) in enumerate(space.blocks)]
        asked = space.asked(vectors)
        known = queries.column("least").to_numpy()
        bound = np.where(np.isnan(known), np.inf, space.distance(known, vectors))
        new = np.flatnonzero(np.isinf(bound))
        if len(new) and len(nodes) > wanted:
            # No bound yet: that of the first candidates holds.
            first = np.hstack(blocks)[: max(4 * wanted, 64)]
            away = (asked[new] ** 2).sum(axis=1)[:, None] + (first**2).sum(axis=1) - 2 * (asked[new] @ first.T)
            bound[new] = np.partition(away, wanted - 1, axis=1)[:, wanted - 1]
        i, j, away = _scanned(asked, blocks, bound, space)
        # Of these only what can be among a query's nearest here is scored.
        order = np.lexsort((away, i))
        i, j, away = i[order], j[order], away[order]
        start = np.searchsorted(i, np.arange(len(askers)))
        last = np.minimum(start + wanted, np.r_[start[1:], len(i)]) - 1
        near = away <= away[last[i]] + SLACK if len(i) else np.zeros(0, bool)
        i, j = i[near], j[near]
        step = 1 << 16
        parts = [np.einsum("ij,ij->i", vectors[i[a : a + step]], others[j[a : a + step]]) for a in range(0, len(i), step)]
        score = np.concatenate(parts) if parts else np.empty(0)
        ids = candidates.column("ids").combine_chunks()
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
        many = np.diff(offsets)[j]
        pair = np.repeat(np.arange(len(i)), many)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        found = values[offsets[j][pair] + within]
        order = np.lexsort((found, -score[pair], i[pair]))
        pair, found = pair[order], found[order]
        start = np.searchsorted(i[pair], np.arange(len(askers)))
        top = np.arange(len(pair)) - start[i[pair]] < wanted
        pair, found = pair[top], found[top]
        own = askers[i[pair]] == nodes[j[pair]]
        return pa.table([askers[i[pair]], found, score[pair], own], schema=schema)

    return run


def _dealt(asking: DataFrame, index: DataFrame, space: Space, plan: Plan) -> DataFrame:
    """Meet the queries of every list with its candidates, block by block."""
    sizes = index.groupBy("list").agg(F.ceil(F.count("*") / F.lit(plan.candidates)).cast("int").alias("ys"))
    counts = asking.groupBy("list").agg(F.ceil(F.count("*") / F.lit(plan.queries)).cast("int").alias("xs"))
    grid = written(sizes.join(counts, "list"), "vector-grid")  # one row per list
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asking.join(grid, "list").select("list", "node", "vector", "least", block("xs").alias("x"), every("ys").alias("y"))
    right = index.join(grid, "list").select(
        "list", "node", "ids", "vector", *[f"block{k}" for k in range(len(space.blocks))], block("ys").alias("y"), every("xs").alias("x")
    )
    place = ["list", "x", "y"]
    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(scan(space, plan), FOUND)


def _ranked(found: DataFrame, most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("place", place).filter(F.col("place") <= most)


def search(
    rows: DataFrame, asks: Column, plan: Plan = Plan(), key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest other rows of every row for which `asks` holds."""
    classes, asked = classes_of(rows, asks, plan, key, vector)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, size, largest = classes.agg(F.count("*"), F.max(F.size("vector")), F.max(norm)).first()
    if not n:
        none = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return none
    space = Space(size, largest, plan)
    lists = max(1, min(plan.most_lists, int(n**0.5) // 2))
    by_chance = lambda df, most: _matrix(
        df.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(most).toArrow().column("vector"), size, np.float64
    )
    centroids = fitted(space.placed(by_chance(classes, plan.per_list * lists)), lists, plan)
    index = written(indexed(classes, space, centroids), "vector-index")
    queries = written(classes.join(asked.select("node").distinct(), "node", "left_semi").select("node", "vector"), "vector-asked")
    probes = probes_needed(index, by_chance(queries, plan.asked), space, centroids, plan)
    asking = written(probing(queries, space, centroids, probes), "vector-probes")

    wanted = plan.nearest + 1
    unknown = F.lit(float("nan")).alias("least")
    near = written(_dealt(asking.filter("turn = 0").select("node", "vector", "list", unknown), index, space, plan), "vector-near")
    least = written(_ranked(near, wanted).filter(F.col("place") == wanted).select("node", F.col("score").alias("least")), "vector-bounds")
    rest = asking.filter("turn > 0").join(least, "node", "left").select("node", "vector", "list", F.coalesce("least", F.lit(float("nan"))).alias("least"))
    found = near.union(_dealt(rest, index, space, plan))
    best = _ranked(found, wanted).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("best"))
    best = written(best, "vector-best")
    # One of a query's own rows is left out: the first that shows its key and its vector.
    itself = F.array_position(F.transform("best", lambda b: b["own"] & (b["vec_id"] == F.col("query_id"))), F.lit(True))
    others = F.filter("best", lambda b, i: i + 1 != F.col("itself"))
    return (
        asked.join(best, "node").withColumn("itself", itself)
        .select("query_id", F.posexplode(F.slice(others, 1, plan.nearest)).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
