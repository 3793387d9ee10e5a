"""Product-quantisation codes by dual-tree Lloyd iterations.

Components become integers floor(scale * x); a vector is cut into consecutive
parts, and each part position has a codebook of its own. Vectors lie in blocks
of bounded size. A block's parts form one tree per position, grown once and
written with the block: nodes hold the box and the component sums of their
parts. A codebook's entries form a tree as well, grown anew in every round.

Assigning a block walks pairs of (node of parts, node of entries) from both
roots. Two bounds drop a pair, both exact in integers: its least distance
exceeds the largest distance to some other node of entries, or no part in the
node can be as near to any of these entries as it is to a reference entry.
When one entry is left for a node, the node's cached count and sums go to it
whole. Leaves with several entries left compare their parts with these in
integers; ties go to the lower index. A round moves no vector: every task
returns at most one row per position and entry.

Defined results: rows whose vector is null, empty, or holds a null or non-finite
component are dropped, as are vectors of other than the commonest length.
Integers beyond +-2^24 are taken as +-2^24, so that all sums fit 64 bits. A
length that `parts` does not divide is cut as evenly as possible. With fewer
rows than entries the codebooks are as long as there are rows; equal entries
keep their places and only the first is used. Rows of a null or repeated key
are coded each; null keys come last where the smallest are taken. An empty
table gives no rows. Further columns pass through; columns named `code` or
`error` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from commerce_lake.llm.common import written
from commerce_lake.llm.vectors import common_size, finite

BOUND = 1 << 24


@dataclass(frozen=True)
class Plan:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    block: int = 8192  # vectors in a block
    leaf: int = 128  # parts in a leaf of a block's tree


@lru_cache(maxsize=64)
def layout(n: int, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of a tree over n items, breadth first: start, end and the first of two
    adjacent children, -1 for a leaf."""
    spans, child = [(0, n)], []
    for start, end in spans:  # grows while it is walked
        if end - start <= leaf:
            child.append(-1)
        else:
            child.append(len(spans))
            spans += [(start, (start + end) // 2), ((start + end) // 2, end)]
    start, end = np.array(spans, np.int64).T
    return start, end, np.array(child, np.int64)


@dataclass
class Tree:
    """Items in tree order; per node its span, first child, box and component sums."""

    order: np.ndarray
    items: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @classmethod
    def grow(cls, items: np.ndarray, leaf: int) -> Tree:
        """Halve the items along the widest side of their box until a leaf is small."""
        start, end, child = layout(len(items), leaf)
        order = np.arange(len(items))
        for s, e, c in zip(start, end, child, strict=True):
            if c >= 0 and items.shape[1]:
                here = order[s:e]
                side = items[here, np.ptp(items[here], axis=0).argmax()]
                order[s:e] = here[np.argpartition(side, (e - s) // 2)]
        placed = items[order]
        shape = (len(start), items.shape[1])
        low, high, sums = np.empty(shape, np.int64), np.empty(shape, np.int64), np.empty(shape, np.int64)
        for node in range(len(start) - 1, -1, -1):
            c = child[node]
            if c < 0:
                span = placed[start[node] : end[node]]
                low[node], high[node], sums[node] = span.min(axis=0), span.max(axis=0), span.sum(axis=0)
            else:
                low[node] = np.minimum(low[c], low[c + 1])
                high[node] = np.maximum(high[c], high[c + 1])
                sums[node] = sums[c] + sums[c + 1]
        return cls(order, placed, start, end, child, low, high, sums)

    def stored(self) -> list[bytes]:
        return [a.astype(np.int32).tobytes() for a in (self.order, self.low, self.high)] + [self.sums.tobytes()]

    @classmethod
    def read(cls, items: np.ndarray, leaf: int, order: bytes, low: bytes, high: bytes, sums: bytes) -> Tree:
        width = items.shape[1]
        place, spans = np.frombuffer(order, np.int32), layout(len(items), leaf)
        shape = (len(spans[0]), width)
        boxes = [np.frombuffer(b, np.int32).reshape(shape).astype(np.int64) for b in (low, high)]
        return cls(place, items[place], *spans, *boxes, np.frombuffer(sums, np.int64).reshape(shape))


class Book:
    """A codebook and the tree of its distinct entries."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        some = entries if entries.shape[1] else entries[:1]
        distinct, first = np.unique(some, axis=0, return_index=True) if some.size else (some, np.arange(len(some)))
        self.tree = Tree.grow(distinct, 1)
        self.index = first[self.tree.order]  # of the entry at each place of the tree
        size = (self.tree.end - self.tree.start)[:, None]
        spans = zip(self.tree.start, self.tree.end, self.tree.sums / size, strict=True)
        #: The place of the entry nearest to a node's mean.
        self.middle = np.array([s + ((self.tree.items[s:e] - m) ** 2).sum(axis=1).argmin() for s, e, m in spans])


def _grouped(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal values, and the run of each value."""
    new = np.r_[True, nodes[1:] != nodes[:-1]]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _live(parts: Tree, book: Book, p: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Which pairs of nodes (runs of equal p) may hold a nearest entry."""
    tree = book.tree
    plow, phigh, elow, ehigh = parts.low[p], parts.high[p], tree.low[e], tree.high[e]
    starts, run = _grouped(p)
    least = (np.maximum(np.maximum(plow - ehigh, elow - phigh), 0) ** 2).sum(axis=1)
    most = (np.maximum(phigh - elow, ehigh - plow) ** 2).sum(axis=1)
    live = least <= np.minimum.reduceat(most, starts)[run]
    # The reference of a node: the middle entry nearest to the centre of its box.
    middle = tree.items[book.middle[e]]
    apart = ((2 * middle - plow - phigh) ** 2).sum(axis=1)
    nearest = np.flatnonzero(apart == np.minimum.reduceat(apart, starts)[run])
    chosen = np.empty(len(starts), np.int64)
    chosen[run[nearest[::-1]]] = nearest[::-1]
    ref = middle[chosen[run]]
    # The least of |x-c|^2 - |x-ref|^2 = c^2 - ref^2 - 2x(c - ref) over both boxes, side by side:
    # for c above ref x is at its highest, for c below at its lowest.
    up = np.clip(phigh, np.maximum(elow, ref), np.maximum(ehigh, ref))
    down = np.clip(plow, np.minimum(elow, ref), np.minimum(ehigh, ref))
    above = np.where(ehigh >= ref, (up - ref) * (up + ref - 2 * phigh), np.iinfo(np.int64).max)
    below = np.where(elow <= ref, (down - ref) * (down + ref - 2 * plow), np.iinfo(np.int64).max)
    return live & (np.minimum(above, below).sum(axis=1) <= 0)


def _children(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both children of every node, or the node itself if it is a leaf; with the place in `nodes`."""
    first = tree.child[nodes]
    inner = np.flatnonzero(first >= 0)
    out = np.r_[np.where(first >= 0, first, nodes), first[inner] + 1]
    return out, np.r_[np.arange(len(nodes)), inner]


def _nearest(items: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The first nearest entry of each item. Products of integers are summed in
    doubles, which is much faster, wherever doubles hold every one of the sums."""
    largest = max(np.abs(items).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * int(largest) ** 2 * items.shape[1] < 1 << 53:
        items, entries = items.astype(np.float64), entries.astype(np.float64)
    return ((entries**2).sum(axis=1) - 2 * (items @ entries.T)).argmin(axis=1)


def assign(parts: Tree, book: Book, leaf_values: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Counts and component sums by entry, and (if `leaf_values`) the entry of every part, in tree order."""
    tree, k = book.tree, len(book.entries)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, parts.items.shape[1]), np.int64)
    code = np.empty(len(parts.items), np.int64) if leaf_values else None
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(p):
        live = _live(parts, book, p, e)
        p, e = p[live], e[live]
        starts, run = _grouped(p)
        single = tree.child[e] < 0
        left = np.diff(np.r_[starts, len(p)])
        whole = starts[(left == 1) & single[starts]]
        entry = book.index[tree.start[e[whole]]]
        np.add.at(counts, entry, parts.end[p[whole]] - parts.start[p[whole]])
        np.add.at(sums, entry, parts.sums[p[whole]])
        if code is not None:
            for node, c in zip(p[whole], entry, strict=True):
                code[parts.start[node] : parts.end[node]] = c
        done = np.zeros(len(starts), bool)
        done[run[whole]] = True
        # Leaves for which nothing but single entries is left.
        certain = np.minimum.reduceat(single, starts) & (parts.child[p[starts]] < 0) & ~done
        for r in np.flatnonzero(certain):
            a, b = starts[r], starts[r] + left[r]
            here = slice(parts.start[p[a]], parts.end[p[a]])
            candidates = np.sort(book.index[tree.start[e[a:b]]])
            found = candidates[_nearest(parts.items[here], book.entries[candidates])]
            np.add.at(counts, found, 1)
            np.add.at(sums, found, parts.items[here])
            if code is not None:
                code[here] = found
        open_ = ~(done | certain)[run]
        p, e = p[open_], e[open_]
        p, source = _children(parts, p)
        e = e[source]
        e, source = _children(tree, e)
        p = p[source]
        by_node = np.argsort(p, kind="stable")
        p, e = p[by_node], e[by_node]
    return counts, sums, code


def _cuts(size: int, parts: int) -> list[tuple[int, int]]:
    return [(size * k // parts, size * (k + 1) // parts) for k in range(parts)]


def _integers(components: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(components.astype(np.float64) * scale), -BOUND, BOUND).astype(np.int64)


BLOCK = "n int, vectors binary, " + ", ".join(f"{c} array<binary>" for c in ("orders", "lows", "highs", "sums"))


def _grown(rows: DataFrame, vector: str, size: int, plan: Plan) -> DataFrame:
    """Blocks: the rows' other columns, their integers and the trees of their parts."""
    others = [c for c in rows.columns if c != vector]
    packed = rows.select(F.struct(*others).alias("row"), F.col(vector).alias("vector"))
    row_type = packed.schema["row"].dataType
    schema = StructType.fromDDL(BLOCK).add("rows", ArrayType(row_type))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(table: pa.Table) -> pa.RecordBatch:
            n = table.num_rows
            components = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            integers = _integers(components, plan.scale).reshape(n, size)
            trees = [Tree.grow(integers[:, a:b], plan.leaf).stored() for a, b in _cuts(size, plan.parts)]
            kept = table.column("row").combine_chunks()
            values = [[n], [integers.astype(np.int32).tobytes()], *[[list(column)] for column in zip(*trees, strict=True)]]
            columns = [pa.array(v, type=f.type) for v, f in zip(values, arrow, strict=False)]
            columns.append(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), kept).cast(arrow.field("rows").type))
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= plan.block:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, plan.block))
                held = table.slice(plan.block).to_batches()
                n -= plan.block
        if n:
            yield block(pa.Table.from_batches(held))

    return packed.mapInArrow(run, schema)


def _blocks(batches: Iterator[pa.RecordBatch], size: int, plan: Plan) -> Iterator[tuple[pa.Array, np.ndarray, list[Tree]]]:
    """The rows, integers and trees of every block of a task, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda name: batch.column(name)[i]  # noqa: E731, B023
            integers = np.frombuffer(get("vectors").as_py(), np.int32).reshape(-1, size).astype(np.int64)
            stored = zip(*[get(c).as_py() for c in ("orders", "lows", "highs", "sums")], strict=True)
            cuts = _cuts(size, plan.parts)
            trees = [Tree.read(integers[:, a:b], plan.leaf, *s) for (a, b), s in zip(cuts, stored, strict=True)]
            yield get("rows").values if "rows" in batch.schema.names else None, integers, trees


def _improved(blocks: DataFrame, books: list[np.ndarray], size: int, plan: Plan) -> list[np.ndarray]:
    """One round: entries replaced by the floored means of the parts nearest to them."""
    widest = max(b - a for a, b in _cuts(size, plan.parts))
    schema = "part int, entry int, n long, sums array<long>"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees_of = [Book(book) for book in books if len(book)]
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        for _, _, trees in _blocks(batches, size, plan):
            for k, tree in enumerate(trees):
                n, total, _ = assign(tree, trees_of[k], leaf_values=False)
                counts[k] += n
                sums[k] += total
        for k, n in enumerate(counts):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pylist(
                [{"part": k, "entry": int(i), "n": int(n[i]), "sums": sums[k][i].tolist()} for i in used], schema=arrow
            )

    trees = blocks.drop("rows", "n").mapInArrow(run, schema)
    total = lambda i: F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}")
    found = trees.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[total(i) for i in range(widest)]).collect()
    books = [book.copy() for book in books]
    for row in found:  # at most one row per position and entry
        book = books[row["part"]]
        book[row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(book.shape[1])]
    return books


def _coded(blocks: DataFrame, books: list[np.ndarray], size: int, plan: Plan, row_type: StructType) -> DataFrame:
    schema = StructType([StructField("row", row_type), *StructType.fromDDL("code string, error long").fields])
    arrow = to_arrow_schema(schema)
    digits = max(2, len(f"{max(plan.entries - 1, 0):x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees_of = [Book(book) for book in books if len(book)]
        names = np.array([f"{i:0{digits}x}" for i in range(max((len(b) for b in books), default=0))], object)
        for rows, integers, trees in _blocks(batches, size, plan):
            code, error = np.full(len(integers), "", object), np.zeros(len(integers), np.int64)
            for (a, b), tree, book in zip(_cuts(size, plan.parts), trees, trees_of, strict=True):
                entry = np.empty(len(integers), np.int64)
                entry[tree.order] = assign(tree, book)[2]
                code += names[entry]
                error += ((integers[:, a:b] - book.entries[entry]) ** 2).sum(axis=1)
            columns = [rows.cast(arrow.field("row").type), pa.array(code, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return blocks.select("rows", "vectors", "orders", "lows", "highs", "sums").mapInArrow(run, schema)


def encode(
    vectors: DataFrame, plan: Plan = Plan(), key: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, list[np.ndarray]]:
    """The rows without their vectors but with `code` and `error`, and the codebooks by position."""
    rows = vectors.drop("code", "error").filter(finite(F.col(vector)) & (F.size(vector) > 0))
    size = common_size(rows, vector)
    rows = rows.filter(F.size(vector) == size)
    blocks = written(_grown(rows, vector, size, plan), "vector-blocks")
    first = rows.select(key, vector).orderBy(F.col(key).asc_nulls_last(), vector).limit(plan.entries).collect()
    starts = _integers(np.array([row[vector] for row in first], np.float64).reshape(len(first), size), plan.scale)
    books = [starts[:, a:b] for a, b in _cuts(size, plan.parts)]
    for _ in range(plan.rounds if first else 0):
        books = _improved(blocks, books, size, plan)
    others = [c for c in rows.columns if c != vector]
    row_type = rows.select(F.struct(*others).alias("row")).schema["row"].dataType
    return _coded(blocks, books, size, plan, row_type).select("row.*", "code", "error"), books
