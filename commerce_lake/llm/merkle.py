"""Merkle manifest of a table, with inclusion proofs by pointer jumping.

Every row is a leaf: the digest of its fields, each written as byte count,
colon and value, or `-` for null. Within a group leaves ascend by key; every
`fan` consecutive nodes become one until a group is down to its subroot, and
the subroots, in the order of their groups, become the root the same way.

Leaves are numbered by range partitions, so no task holds a group; a level is
one aggregate over groups of at most `fan` nodes, each level a fan-th of the
one below. A lowest-level run of leaves is kept as one row of its members.

Proofs: every node above the leaves starts with a pointer to its parent and
the segment of siblings it meets on the way there, left and right of it. In
each round nodes join the node they point to, take over its pointer and append
its segment, which doubles the distance, until all point to the root. A round
moves only nodes that are not there yet, and joins them with only those that can
still be pointed to (levels above the distance so far), a table that shrinks by
the distance's power of the fan. Leaves take their siblings from their run and the
rest of the path from the run's segment, in one join of runs.

A proof is the digest of all its siblings, from the leaf up, left to right.
`folded` recomputes the root from a leaf, given or changed, along its proof.

Defined results: null keys come first, in one place; rows of one key are
ordered by their leaves, and equal rows are leaves of their own; null groups
come first; empty texts have byte count 0; a table of one row has its leaf for
root and an empty proof; an empty table gives no rows. Further columns are
neither hashed nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import written
from commerce_lake.llm.shards import numbered


@dataclass(frozen=True)
class Plan:
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
    key: str = "doc_id"
    group: str = "lang"
    fan: int = 8


#: The tree of subroots; a group's tree is known by the number of its first row, which is 0 or more.
TOP = -1


def digest(fields: list[Column]) -> Column:
    """Digest of fields, each with its byte count, so that none can run into the next."""
    spelled = []
    for field in fields:
        value = field.cast("string")
        spelled.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*spelled), 256)


def _height(n: Column, fan: int) -> Column:
    """Levels above n leaves: the least h with fan^h >= n."""
    powers = [fan**h for h in range(64) if fan**h < 1 << 62]
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < n))


def _digests(members: Column) -> Column:
    return F.transform(members, lambda m: m["digest"])


def _run_digest(members: Column) -> Column:
    return F.sha2(F.array_join(_digests(members), ""), 256)


def _segment(members: Column, place: Column) -> Column:
    """Siblings before and after the member at a place, from 0, of a run."""
    digests = _digests(members)
    left = F.slice(digests, F.lit(1), place)
    right = F.slice(digests, place + 2, F.size(members))
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def _node(tree: Column, level: Column, at: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), at.cast("long").alias("at"))


def _runs(nodes: DataFrame, fan: int, *held: str) -> DataFrame:
    """Every `fan` consecutive nodes of a tree as one row, members in order."""
    up = F.floor(F.col("at") / F.lit(fan)).cast("long").alias("up")
    members = F.array_sort(F.collect_list(F.struct("at", "digest", *held))).alias("members")
    return nodes.groupBy("tree", "height", up).agg(members).withColumnRenamed("up", "at")


def _rise(nodes: DataFrame, fan: int, level: int, height: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels from `level` to `height`: links of their nodes to the runs above, and the tops of trees among these."""
    links, tops = [], []
    for below in range(level, height):
        runs = written(_runs(nodes.filter(F.col("height") > below), fan, "id"), f"{name}-runs")
        up = _node(F.col("tree"), F.lit(below + 1), F.col("at"))
        members = runs.select(up.alias("up"), "members", F.posexplode("members").alias("place", "member"))
        path = F.array(_segment(F.col("members"), F.col("place"))).alias("path")
        links.append(members.select(F.col("member.id").alias("node"), "up", path))
        nodes = runs.select("tree", "height", "at", up.alias("id"), _run_digest(F.col("members")).alias("digest"))
        tops.append(nodes.filter(F.col("height") == below + 1))
    return links, tops


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def _jumped(nodes: DataFrame) -> DataFrame:
    """(node, path) of every node: its siblings all the way to the root."""
    distance, done = 1, []
    while True:
        # A level at least is climbed with each step, so lower nodes are nobody's target any more.
        targets = _union([nodes, *done]).filter(F.col("node.level") >= distance)
        targets = written(targets.select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("path").alias("_path")), "merkle-targets")
        moved = nodes.join(targets, F.col("up") == F.col("_node"), "left").select(
            "node", F.coalesce("_up", "up").alias("up"),
            F.when(F.col("_up").isNull(), F.col("path")).otherwise(F.concat("path", "_path")).alias("path"),
            F.col("_up").isNotNull().alias("moved"),
        )
        moved = written(moved, "merkle-paths")
        # The root points to none: what found no target has arrived there.
        done.append(moved.filter("NOT moved").drop("moved"))
        nodes = moved.filter("moved").drop("moved")
        if nodes.isEmpty():
            return _union(done)
        distance *= 2


def manifest(rows: DataFrame, plan: Plan = Plan(), changed: dict[str, Column] | None = None) -> DataFrame:
    """One row per row: key, leaf, subroot, root, proof, and `folded`, the root
    recomputed along the proof from the leaf of the row with fields replaced by `changed`."""
    fields = [F.col(f) for f in plan.fields]
    altered = [(changed or {}).get(f, F.col(f)) for f in plan.fields]
    leaves = rows.select(
        F.col(plan.key).alias("key"), F.col(plan.group).alias("name"),
        digest(fields).alias("digest"), digest(altered).alias("altered"),
    )
    leaves = written(numbered(written(leaves, "merkle-leaves"), ["name", "key", "digest"], "number"), "merkle-numbered")
    groups = leaves.groupBy("name").agg(F.min("number").alias("tree"), F.count("*").alias("n"))
    groups = written(groups.select("tree", "name", _height(F.col("n"), plan.fan).alias("height")), "merkle-groups")
    count, highest = groups.agg(F.count("*"), F.max("height")).first()

    placed = leaves.join(groups.withColumnRenamed("name", "_name"), F.col("name").eqNullSafe(F.col("_name"))).select(
        "tree", "height", (F.col("number") - F.col("tree")).alias("at"), "key", "digest", "altered"
    )
    runs = written(_runs(placed, plan.fan, "key", "altered"), "merkle-leaf-runs")
    # A leaf alone in its group is the subroot; any other run is a node of level 1.
    lone = F.col("height") == 0
    runs = runs.withColumn("id", _node(F.col("tree"), F.when(lone, 0).otherwise(1), F.col("at")))
    made = F.when(lone, F.col("members")[0]["digest"]).otherwise(_run_digest(F.col("members")))
    nodes = runs.select("tree", "height", "at", "id", made.alias("digest"))

    links, tops = _rise(nodes, plan.fan, 1, highest or 0, "merkle")
    subroots = written(_union([nodes.filter("height <= 1"), *tops]), "merkle-subroots")
    top_height = 0
    while plan.fan**top_height < count:
        top_height += 1
    peak = subroots.select("digest")
    if top_height:
        above = numbered(subroots.select("tree", "id", "digest"), ["tree"], "at").select(
            F.lit(TOP).cast("long").alias("tree"), F.lit(highest + top_height).alias("height"), "at", "id", "digest"
        )
        more, last = _rise(above, plan.fan, highest, highest + top_height, "merkle-top")
        links, peak = links + more, last[-1].select("digest")
    root = peak.first()
    paths = _jumped(_union(links)) if links else runs.select(F.col("id").alias("node"), F.array().cast("array<struct<left:string,right:string>>").alias("path")).limit(0)

    member = (
        runs.join(paths, F.col("id") == F.col("node"), "left")
        .select("tree", "height", "path", "members", F.posexplode("members").alias("place", "member"))
    )
    onward = F.coalesce("path", F.array().cast("array<struct<left:string,right:string>>"))
    path = F.when(lone, onward).otherwise(F.concat(F.array(_segment(F.col("members"), F.col("place"))), onward))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    fold = F.aggregate("path", F.col("member.altered"), lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))
    found = member.select("tree", "member", path.alias("path")).select(
        "tree", F.col("member.key").alias("key"), F.col("member.digest").alias("leaf"),
        F.sha2(siblings, 256).alias("proof_sha256"), fold.alias("folded"),
    )
    names = subroots.select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot"))
    return found.join(names, F.col("tree") == F.col("_tree")).select(
        F.col("key").alias(plan.key), "leaf", "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"),
        "proof_sha256", "folded",
    )
