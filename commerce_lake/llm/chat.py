"""Chat formatting as a prefix tree.

Conversations that share their first turns share nodes of a tree: a node is a
turn after one particular history. All trees are emitted as one stream,
depth-first, with the tokens of every node once. Each segment of the stream
carries the position of its first token in its conversation, and the intervals
of the stream that hold its ancestors: with these and itself, causally, it may
attend.

Depth-first order is the order of sorted paths. Paths are chains of digests,
one per turn, each of all turns so far; sorted, the conversations of a tree
stand together and prefixes come first, and the first path that holds a node
emits it. So the order comes from a range sort of distinct paths, offsets from
running sums in blocks of ranks, and no task holds a tree: one opening turn of
a third of all conversations is one node among many ranges. A conversation is
one record, as a document is; only its digests are gathered while the tree is
built.

The template of a turn is "### ", role, ": ", text, "</turn>" and a line feed.
Inside roles and texts a backslash goes before backslashes, number signs and
the slash of "</", and in roles before colons, so no text can spell a mark and
the original can be read back. The loss mask covers texts of assistants.

Defined results: null roles and texts are empty; rows of a null conversation
form one; null turns come first, equal turns are ordered by digest; repeated
rows are turns of their own; equal conversations share all segments; an empty
table gives empty results. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from commerce_lake.llm.common import written
from commerce_lake.llm.packing import Encoder
from commerce_lake.llm.shards import numbered

# The marks of the template.
OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>\n"
TRAINED = "assistant"
RANKS = 10_000  # paths whose running sum one task takes

_SPECIAL = re.compile(r"[\\#]|(?<=<)/")
_ROLE_SPECIAL = re.compile(r"[\\#:]|(?<=<)/")
_ESCAPED = re.compile(r"\\(.)", re.S)
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)


def escape(text: str, special: re.Pattern = _SPECIAL) -> str:
    return special.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a formatted turn."""
    return OPEN + escape(role, _ROLE_SPECIAL) + SEPARATOR, escape(text), CLOSE


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    head = _HEAD.match(formatted)
    return unescape(head[1]), unescape(formatted[head.end() : -len(CLOSE)])


@dataclass(frozen=True)
class Forest:
    """segments: start, n_tokens, position, depth, tree, attend, ids, loss_from, loss_to;
    branches: conv, n_turns, starts (of its segments, from the first turn on)."""

    segments: DataFrame
    branches: DataFrame


@pandas_udf(ArrayType(StringType()))
def _chain(paths: pd.Series) -> pd.Series:
    """Digests of all turns so far, from the digests of turns."""

    def one(path) -> list[str]:
        chain, last = [], ""
        for digest in path:
            last = hashlib.blake2b((last + digest).encode(), digest_size=16).hexdigest()
            chain.append(last)
        return chain

    return paths.map(one)


def _tokenized(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Token ids of every distinct turn: head, body and tail apart, so that the mask has exact ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            ids, bounds = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head, body, tail = (encoder.ids(part) for part in format_turn(role, text))
                ids.append(np.concatenate([head, body, tail]).tobytes())
                end = len(head) + len(body)
                bounds.append((end + len(tail), len(head), end if role == TRAINED else len(head)))
            n, first, last = zip(*bounds, strict=True) if bounds else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(ids, pa.binary()), *[pa.array(c, pa.int32()) for c in (n, first, last)]],
                names=["digest", "ids", "n_tokens", "loss_from", "loss_to"],
            )

    return turns.mapInArrow(run, "digest string, ids binary, n_tokens int, loss_from int, loss_to int")


def _running(rows: DataFrame, value: str, total: str) -> DataFrame:
    """`total`: the sum of `value` over all smaller ranks, in blocks of ranks."""
    blocks = rows.withColumn("_block", F.floor(F.col("rank") / RANKS))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(before(Window.partitionBy("_block").orderBy("rank"))), F.lit(0))
    # One row per block of ranks.
    bases = blocks.groupBy("_block").agg(F.sum(value).alias("_sum")).select(
        "_block", F.coalesce(F.sum("_sum").over(before(Window.orderBy("_block"))), F.lit(0)).alias("_base")
    )
    return blocks.withColumn("_inside", inside).join(bases, "_block").withColumn(total, F.col("_base") + F.col("_inside")).drop("_block", "_inside", "_base")


SEGMENTS = (
    "start long, position long, depth int, tree long, digest string, attend array<struct<start:long,end:long>>"
)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments that a path emits: those from its first new depth on."""
    for batch in batches:
        out = []
        for path in batch.to_pylist():
            merged: list[list[int]] = []
            for depth, node in enumerate(path["nodes"]):
                if depth >= path["new_from"]:
                    attend = [{"start": a, "end": b} for a, b in merged]
                    out.append((node["start"], node["position"], depth, path["nodes"][0]["start"], node["digest"], attend))
                end = node["start"] + node["n_tokens"]
                if merged and merged[-1][1] == node["start"]:
                    merged[-1][1] = end
                else:
                    merged.append([node["start"], end])
        columns = zip(*out, strict=True) if out else [()] * 6
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), span]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["start", "position", "depth", "tree", "digest", "attend"],
        )


def build(conversations: DataFrame, tokenizer: str) -> Forest:
    """The prefix trees of a table (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    )
    distinct = turns.groupBy("digest").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    tokens = written(_tokenized(distinct, tokenizer), "turns")
    lengths = tokens.select("digest", "n_tokens")

    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("turn"), F.lit(-(2**63))).alias("turn"), "digest")))
    paths = turns.groupBy("conv_id").agg(ordered.alias("path")).select(
        F.col("conv_id").alias("conv"), F.transform("path", lambda t: t["digest"]).alias("path")
    )
    paths = written(paths.withColumn("chain", _chain("path")).withColumn("leaf", F.element_at("chain", -1)), "conversations")
    apart = paths.groupBy("leaf").agg(F.first("chain").alias("chain"), F.first("path").alias("path"))
    ranked = written(numbered(apart.withColumn("order", F.array_join("chain", "")), ["order"], "rank").drop("order"), "ranked")

    each = ranked.select("rank", F.posexplode(F.arrays_zip("chain", "path")).alias("depth", "turn")).select(
        "rank", "depth", F.col("turn.chain").alias("node"), F.col("turn.path").alias("digest")
    ).join(lengths, "digest")
    along = Window.partitionBy("rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    each = written(each.withColumn("position", F.coalesce(F.sum("n_tokens").over(along), F.lit(0)).cast("long")), "nodes-of-paths")
    # The first path that holds a node emits it.
    nodes = each.groupBy("node").agg(F.min(F.struct("rank", "depth", "position", "n_tokens")).alias("first")).select("node", "first.*")
    nodes = written(nodes, "nodes")
    fresh = nodes.groupBy("rank").agg(
        F.sum("n_tokens").alias("tokens"), F.min("depth").alias("new_from"), F.min("position").alias("from_position")
    )
    based = _running(fresh, "tokens", "base")
    starts = nodes.join(based.select("rank", "base", "from_position"), "rank").select(
        "node", (F.col("base") + F.col("position") - F.col("from_position")).alias("start")
    )
    node = F.struct("depth", "start", "position", "n_tokens", "digest")
    laid = each.join(starts, "node").groupBy("rank").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    laid = written(laid.join(based.select("rank", "new_from"), "rank", "left"), "laid")
    # A path that is a prefix of another one emits all its own nodes, so only equal ones have nothing new.
    emitted = laid.filter("new_from IS NOT NULL").select("nodes", "new_from").mapInArrow(_emit, SEGMENTS)
    segments = emitted.join(tokens, "digest").drop("digest")
    branches = (
        paths.select("conv", "leaf", F.size("path").cast("long").alias("n_turns"))
        .join(ranked.select("leaf", "rank"), "leaf")
        .join(laid.select("rank", F.transform("nodes", lambda n: n["start"]).alias("starts")), "rank")
        .select("conv", "n_turns", "starts")
    )
    return Forest(written(segments, "segments"), written(branches, "branches"))


def read_back(forest: Forest, tokenizer: str) -> DataFrame:
    """(conv, n_turns, turns, formatted_chars): every conversation from its
    segments' tokens, with role, text and the text under the mask per turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            rows = []
            for data, a, b in zip(*[batch.column(c).to_pylist() for c in ("ids", "loss_from", "loss_to")], strict=True):
                ids = np.frombuffer(data, "<u4")
                formatted = encoder.text(ids)
                rows.append((*parse_turn(formatted), unescape(encoder.text(ids[a:b])), len(formatted)))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            types = [pa.string(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("start"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["start", "role", "text", "masked", "chars"],
            )

    decoded = forest.segments.select("start", "ids", "loss_from", "loss_to").mapInArrow(
        run, "start long, role string, text string, masked string, chars long"
    )
    uses = forest.branches.select("conv", "n_turns", F.posexplode("starts").alias("at", "start"))
    turn = F.struct("at", "role", "text", "masked", "chars")
    turns = uses.join(decoded, "start").groupBy("conv", "n_turns").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda acc, t: acc + t["chars"])
    return turns.withColumn("formatted_chars", chars)


def spelled(turns: Column) -> Column:
    """role, line feed, text, line feed of each turn."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
