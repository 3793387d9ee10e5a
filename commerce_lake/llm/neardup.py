"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's set are the hashes of its distinct word shingles. Two fixed
permutations of one universe make the signature: the first places every
element, the second, circularly shifted by k, gives coordinate k as the
smallest value over the set. Shifts of a permutation are neighbouring entries
of one table, so a row of the signature is a contiguous read.

Documents of equal sets form a class with the smallest doc_id as
representative; only representatives are compared. Bands of the signature
give buckets. Within a bucket members are not paired with each other:

1. Each member is paired with a few hubs (the smallest id and the smallest
   under other orders), as a bucket minimum joined back: at most
   bands * hubs pairs per representative, however large a bucket is.
2. Pairs are verified on the full sets; the verified ones give components.
3. What no hub can decide is decided in full: in a bucket of three or more
   members of several components, the members outside its largest component
   are compared with all others, in blocks of bounded size. A block returns
   one verified link per member and foreign component, never all pairs.

So every two representatives that share a bucket and are similar end in one
component. A pair at the threshold shares a bucket with probability
1 - (1 - t^rows)^bands, 0.999995 for t = 0.8 and the production parameters.

Defined results: null and empty texts have no shingles and link with nothing;
a text of fewer words than a shingle is one shingle; rows of one doc_id are
one node; rows of a null doc_id link with nothing, have no component and are
kept; further columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import with_text_columns, written
from commerce_lake.llm.components import components

UNIVERSE = 1 << 20
CHUNK = 512  # elements whose table rows are held at once


@dataclass(frozen=True)
class Plan:
    words: int = 5
    percent: int = 80  # least 100 * intersection / union
    bands: int = 40
    rows: int = 6
    hubs: int = 3
    block: int = 1000  # members compared at once in a bucket
    seed: int = 11


_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles, A-Z folded."""
    words = text.encode().lower().split()  # of bytes: folds and splits ASCII only
    if not words:
        return np.empty(0, np.int64)
    names = dict.fromkeys(words)
    codes = {w: xxhash.xxh3_64_intdigest(w) for w in names}
    hashed = np.array([codes[w] for w in words], np.uint64)
    n = max(len(words) - size + 1, 1)
    state = np.full(n, min(len(words), size), np.uint64)
    for k in range(min(size, len(words))):
        state = (state ^ hashed[k : k + n]) * _ODD[0]
        state ^= state >> np.uint64(32)
        state *= _ODD[1]
        state ^= state >> np.uint64(29)
    return np.unique(state.view(np.int64))


class Signer:
    """Signatures by two permutations, the second circularly shifted."""

    def __init__(self, plan: Plan) -> None:
        self.plan = plan
        width = plan.bands * plan.rows
        state = np.random.RandomState(plan.seed)
        self.first = state.permutation(UNIVERSE).astype(np.int32)
        second = state.permutation(UNIVERSE).astype(np.uint32)
        around = np.concatenate([second, second[: width - 1]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(around, width)

    def sign(self, elements: np.ndarray) -> np.ndarray:
        places = self.first[elements & (UNIVERSE - 1)]
        parts = [self.shifted[places[i : i + CHUNK]].min(axis=0) for i in range(0, len(places), CHUNK)]
        return np.minimum.reduce(parts)

    def band_keys(self, elements: np.ndarray) -> list[int]:
        if not len(elements):
            return []
        rows = self.sign(elements).reshape(self.plan.bands, self.plan.rows)
        keys = [xxhash.xxh3_64_intdigest(row.tobytes(), seed=band) for band, row in enumerate(rows)]
        return np.array(keys, np.uint64).view(np.int64).tolist()


def signed(documents: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """(key, n_shingles, same, bands): same is equal for equal sets only."""

    def make():
        signer = Signer(plan)

        def work(texts: list[str]) -> list[list]:
            columns: list[list] = [[], [], []]
            for t in texts:
                elements = shingle_set(t, plan.words)
                columns[0].append(len(elements))
                columns[1].append(hashlib.blake2b(elements.tobytes(), digest_size=16).digest())
                columns[2].append(signer.band_keys(elements))
            return columns

        return work

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return with_text_columns(rows, "text", make, "n_shingles long, same binary, bands array<long>", drop_text=True)


def sets_of(documents: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    def make():
        return lambda texts: [[shingle_set(t, plan.words) for t in texts]]

    rows = documents.select(F.col(key).alias("node"), F.col(text).alias("text"))
    return with_text_columns(rows, "text", make, "elements array<long>", drop_text=True)


def _order(hub: int) -> Column:
    """What a bucket's hub number `hub` is the smallest by."""
    return F.col("node") if hub == 0 else F.xxhash64("node", F.lit(hub))


def star_pairs(members: DataFrame, plan: Plan) -> DataFrame:
    """Distinct (a, b) of members and hubs of their buckets that sizes do not rule out."""
    hubs = members.groupBy("bucket").agg(
        F.count("*").alias("n"),
        *[F.min(F.struct(_order(k).alias("by"), "node", "size")).alias(f"hub{k}") for k in range(plan.hubs)],
    ).filter("n > 1")
    each = F.explode(F.array_distinct(F.array(*[F.struct(F.col(f"hub{k}.node"), F.col(f"hub{k}.size")) for k in range(plan.hubs)])))
    return (
        members.join(hubs, "bucket").select("node", "size", each.alias("hub"))
        .filter(F.col("node") != F.col("hub.node"))
        .filter(100 * F.least("size", "hub.size") >= plan.percent * F.greatest("size", "hub.size"))
        .select(F.greatest("node", "hub.node").alias("a"), F.least("node", "hub.node").alias("b")).distinct()
    )


def verified(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    left, right = (sets.select(F.col("node").alias(n), F.col("elements").alias(f"e{n}")) for n in "ab")
    both = F.size(F.array_intersect("ea", "eb"))
    return (
        pairs.join(left, "a").join(right, "b")
        .withColumn("both", both)
        .filter(100 * F.col("both") >= plan.percent * (F.size("ea") + F.size("eb") - F.col("both")))
        .select("a", "b")
    )


LINKS = "a long, b long"


def compare_blocks(plan: Plan):
    """Links between a block of askers and a block of members of one bucket."""

    signers: list[Signer] = []  # one per task, made for its first block

    def run(rows: pa.Table) -> pa.Table:
        node, group = (rows.column(c).to_numpy() for c in ("node", "group"))
        asks = rows.column("asks").to_numpy(zero_copy_only=False)
        elements = [e.values.to_numpy() for e in rows.column("elements").combine_chunks()]
        if not signers:
            signers.append(Signer(plan))
        signer = signers[0]
        signatures = np.array([signer.sign(e) for e in elements])
        sizes = np.array([len(e) for e in elements])
        width = signatures.shape[1]
        # Six standard deviations of the estimate below the threshold.
        t = plan.percent / 100
        least = (t - 6 * (t * (1 - t) / width) ** 0.5) * width
        others = np.flatnonzero(~asks)
        links = set()
        for i in np.flatnonzero(asks):
            near = others[
                (group[others] != group[i])
                & (100 * np.minimum(sizes[others], sizes[i]) >= plan.percent * np.maximum(sizes[others], sizes[i]))
            ]
            near = near[(signatures[near] == signatures[i]).sum(axis=1) >= least]
            linked = set()
            for j in near:
                if group[j] not in linked:
                    both = len(np.intersect1d(elements[i], elements[j], assume_unique=True))
                    if 100 * both >= plan.percent * (sizes[i] + sizes[j] - both):
                        linked.add(group[j])
                        links.add((int(node[i]), int(node[j])))
        a, b = zip(*sorted(links), strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def undecided(members: DataFrame, labels: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, node, group, asks) of buckets that hubs could not decide: three
    or more members of several components. `asks` is false in the bucket's
    largest component."""
    named = (
        members.select("bucket", "node").join(labels.withColumnsRenamed({"node": "_node"}), F.col("node") == F.col("_node"), "left")
        .select("bucket", "node", F.coalesce("component", "node").alias("group"))
    )
    per_group = named.groupBy("bucket", "group").agg(F.count("*").alias("n"))
    open_buckets = per_group.groupBy("bucket").agg(
        F.sum("n").alias("total"), F.count("*").alias("groups"), F.max(F.struct("n", "group")).alias("largest")
    ).filter("total > 2 and groups > 1")
    return named.join(open_buckets, "bucket").select(
        "bucket", "node", "group", (F.col("group") != F.col("largest.group")).alias("asks"), "total"
    )


def block_links(open_members: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Compare askers with all members of their bucket, block by block.

    A bucket's members are dealt into blocks; a block of askers meets each
    block of members in a group of its own, so no group exceeds two blocks.
    """
    blocks = F.ceil(F.col("total") / plan.block).cast("int")
    dealt = open_members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    asking = dealt.filter("asks").select("bucket", "node", "group", F.lit(True).alias("asks"), F.col("block").alias("x"), F.explode(every).alias("y"))
    asked = dealt.select("bucket", "node", "group", F.lit(False).alias("asks"), F.explode(every).alias("x"), F.col("block").alias("y"))
    placed = asking.union(asked).join(sets, "node")
    return placed.groupBy("bucket", "x", "y").applyInArrow(compare_blocks(plan), LINKS).distinct()


def link(documents: DataFrame, plan: Plan = Plan(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept."""
    rows = written(signed(documents, plan, key, text), "signed")
    classes = (
        rows.filter("key IS NOT NULL AND n_shingles > 0")
        .groupBy("same").agg(F.min("key").alias("node"), F.first("n_shingles").alias("size"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    )
    classes = written(classes, "classes")
    members = classes.select("node", "size", F.explode("bands").alias("bucket"))
    # Only buckets with several members go on.
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = written(members.join(shared, "bucket"), "members")
    involved = written(members.select("node").distinct(), "involved")
    sets = written(
        sets_of(documents.join(involved, documents[key] == involved["node"], "left_semi"), plan, key, text).filter(F.size("elements") > 0),
        "sets",
    )
    links = written(verified(star_pairs(members, plan), sets, plan), "links")
    labels = components(links.toDF("u", "v"))
    open_members = written(undecided(members, labels, plan), "undecided")
    if not open_members.isEmpty():
        more = written(block_links(open_members, sets, plan), "block-links")
        joined = more.toDF("u", "v").union(labels.toDF("u", "v"))
        labels = components(joined)
    named = classes.join(labels.withColumnsRenamed({"node": "_node"}), F.col("node") == F.col("_node"), "left").select(
        "same", "node", F.coalesce("component", "node").alias("component")
    )
    # A class of one document that is linked with nothing needs no row here.
    several = classes.filter("copies > 1").select(F.col("same").alias("_same"))
    named = named.join(several, F.col("same") == F.col("_same"), "left").filter("_same IS NOT NULL OR component <> node")
    named = written(named.select(F.col("same").alias("_class"), "component"), "named")
    linked = rows.select("key", "n_shingles", F.when(F.col("key").isNotNull() & (F.col("n_shingles") > 0), F.col("same")).alias("same"))
    found = linked.join(named, F.col("same") == F.col("_class"), "left")
    component = F.coalesce("component", "key")
    return found.select(
        F.col("key").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )
