"""Language-model scores by deleted interpolation.

Tokens are the words of a text with A-Z folded, then one end. The model mixes
maximum-likelihood estimates of the orders from `Plan.order` down to zero; for
order three, with the contexts h3 of two tokens and h2 of one:

    p(w | h) = a3[b] * c(h3, w) / c(h3) + a2[b] * c(h2, w) / c(h2) + a1[b] * c(w) / N + a0[b] / (V + 1)

b is a frequency bucket: the longest context that training holds, by its length
and the bit length of its count. A context reaches back to the end before the
text and no further; where it is shorter than an order asks for, that order's
estimate is the one of the order below. The weights of each bucket are learned
by expectation-maximisation on counts of held-out documents (`held` of `folds`
folds of the training part), against estimates from the rest; the estimates
used for scores come from all training documents.

How it runs. A task turns its documents into blocks of at most
`block_tokens` tokens. A block asks for the corpus counts of each of its
distinct words and longer runs of words once, and at the same time tells its own counts
of them: requests are sorted arrays, cut by key range into buckets of bounded
size. One shuffle brings the requests of a bucket together, which sums counts
and answers every block; a run that every document holds is one entry per
block. A second shuffle brings the answers back to the blocks. Nothing is
pruned, and all that is gathered grows with the corpus.

Words and runs of words are known by 63-bit hashes of their bytes.

Defined results: a null or empty text is one end; a null key falls into the
fold of the empty string; keys keep their type; repeated rows count and are scored each; an empty
table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from commerce_lake.llm.common import written

END = b" "  # no word holds white space
CONTEXTS = 64  # frequency buckets of each length of context


@dataclass(frozen=True)
class Plan:
    order: int = 2
    folds: int = 7
    test: int = 2  # the fold that the model never learns from
    held: int = 5  # the fold that weights are learned on
    block_tokens: int = 1_000_000
    bucket_entries: int = 500_000
    rounds: int = 30
    settled: float = 1e-5


def fold_of(key: str, plan: Plan) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(plan.folds)).cast("int")


def _squeeze(values: np.ndarray) -> bytes:
    """Integers, compressed byte plane by byte plane."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(planes).tobytes())


def _expand(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def _squeeze_sorted(values: np.ndarray) -> bytes:
    return _squeeze(np.diff(values, prepend=np.uint64(0)))


def _expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_expand(data, "<u8"), dtype=np.uint64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one after the other: only one block is unpacked at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


BLOCKS = "block long, keys array<{key}>, folds array<int>, lengths array<int>, words binary, tokens binary, n_entries long"


def encode(documents: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """Blocks of documents: word hashes by local number (0 is the end), and the
    local numbers of all tokens, document after document."""
    rows = documents.select(F.col(key).alias("key"), fold_of(key, plan).alias("fold"), F.col(text).alias("text"))
    schema = StructType.fromDDL(BLOCKS.format(key=rows.schema["key"].dataType.simpleString()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            keys, folds, texts = batch.column("key"), batch.column("fold"), batch.column("text")
            row = 0
            while row < batch.num_rows:
                first, names, tokens, lengths = row, {END: 0}, [], []
                while row < batch.num_rows and (row == first or len(tokens) < plan.block_tokens):
                    before = len(tokens)
                    tokens += [names.setdefault(w, len(names)) for w in (texts[row].as_py() or "").encode().lower().split()]
                    tokens.append(0)
                    lengths.append(len(tokens) - before)
                    row += 1
                words = np.array([xxhash.xxh3_64_intdigest(w) & ~1 for w in names], "<u8")
                local = np.array(tokens, "<u4")
                columns = [
                    [block], [keys.slice(first, row - first).to_pylist()], [folds.slice(first, row - first).to_pylist()], [lengths],
                    [words.tobytes()], [_squeeze(local)], [len(words) + len(local)],
                ]
                types = [pa.int64(), pa.list_(keys.type), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)
                block += 1

    return rows.mapInArrow(run, schema)


def _mixed(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of runs, from those of their contexts and last words; the lowest bit tells them from words."""
    mixed = (context * np.uint64(0x9E3779B97F4A7C15)) ^ (word >> np.uint64(1))
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return mixed | np.uint64(1)


class Runs:
    """The distinct runs of one order in a block.

    `of` is the run that ends at each token. A run whose context would reach
    beyond the end before its text is cut: it stands for the run of the order
    below. `context` is the run before the last word, `word` that word, `lower`
    the run without its first word; `whole` numbers the runs that are not cut.
    """

    def __init__(self, below: np.ndarray, tokens: np.ndarray, words: int, since: np.ndarray, order: int) -> None:
        before = np.concatenate([[0], below[:-1]])
        codes = np.where(since >= order - 2, before * words + tokens, -1 - below)
        distinct, first, self.of = np.unique(codes, return_index=True, return_inverse=True)
        self.cut = distinct < 0
        self.whole = np.flatnonzero(~self.cut)
        self.context, self.word = np.divmod(np.where(self.cut, 0, distinct), words)
        self.lower = below[first]


class Block:
    """The distinct words and runs of a block, in the order their counts are asked for."""

    def __init__(self, row: dict, order: int) -> None:
        hashes = np.frombuffer(row["words"], "<u8")
        self.tokens = _expand(row["tokens"], "<u4").astype(np.int64)
        self.n_words = len(hashes)
        lengths = np.asarray(row["lengths"], np.int64)
        since = np.arange(len(self.tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # The token before a document's first one is the end of the one before it, or local number 0.
        self.runs, below, known, keys = [], self.tokens, hashes, [hashes]
        for k in range(2, order + 1):
            runs = Runs(below, self.tokens, self.n_words, since, k)
            made = np.zeros(len(runs.cut), "<u8")
            made[runs.whole] = _mixed(known[runs.context[runs.whole]], hashes[runs.word[runs.whole]])
            keys.append(made[runs.whole])
            self.runs.append(runs)
            below, known = runs.of, made
        self.sizes = [len(k) for k in keys]
        whole = np.concatenate(keys)
        self.order = np.argsort(whole)
        self.keys = whole[self.order]

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """Counts over the chosen tokens, in the order of keys."""
        found = [np.bincount(self.tokens[chosen], minlength=self.n_words)]
        found += [np.bincount(r.of[chosen], minlength=len(r.cut))[r.whole] for r in self.runs]
        return np.concatenate(found)[self.order]

    def answered(self, counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Counts of words, and for each order from two, the counts of runs and of their contexts."""
        placed = np.empty_like(counts)
        placed[self.order] = counts
        words, *asked = np.split(placed, np.cumsum(self.sizes)[:-1])
        below, found = words, []
        for runs, known in zip(self.runs, asked, strict=True):
            own, context = np.zeros(len(runs.cut), np.int64), below[runs.context]
            own[runs.whole] = known
            if found:
                cut = runs.lower[runs.cut]
                own[runs.cut], context[runs.cut] = found[-1][0][cut], found[-1][1][cut]
            found.append((own, context))
            below = own
        return words, found

    def per_run(
        self, words: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """What `answered` gives, for each of the distinct runs of the highest order:
        counts of its last word, and of its shortened forms and their contexts."""
        at, aligned = np.arange(len(self.runs[-1].cut)), []
        for runs, (own, context) in zip(reversed(self.runs), reversed(found), strict=True):
            aligned.append((own[at], context[at]))
            # The lowest runs are pairs, none of them cut: their last words are known.
            at = runs.word[at] if runs is self.runs[0] else runs.lower[at]
        return words[at], aligned[::-1]


REQUESTS = "bucket int, block long, keys binary, kept binary, held binary, whole boolean"


def requests(blocks: DataFrame, bits: int, plan: Plan, whole: bool) -> DataFrame:
    """What blocks ask and tell, cut into 2^bits ranges of keys. With `whole`
    they tell their counts and ask for those of all training documents;
    without, they tell nothing and ask for the counts without held-out ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row, plan.order)
            fold = np.repeat(row["folds"], row["lengths"])
            if whole:
                kept = block.counts((fold != plan.test) & (fold != plan.held)).astype("<u4")
                held = block.counts(fold == plan.held).astype("<u4")
            else:
                kept = held = np.zeros(len(block.keys), "<u4")
            # Only ranges that hold a key of the block: with many blocks and ranges most are empty.
            occupied, starts = np.unique(block.keys >> np.uint64(64 - bits), return_index=True)
            for bucket, a, b in zip(occupied.tolist(), starts, [*starts[1:], len(block.keys)], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket], pa.int32()), pa.array([row["block"]], pa.int64()),
                        pa.array([_squeeze_sorted(block.keys[a:b])], pa.binary()),
                        pa.array([_squeeze(kept[a:b])], pa.binary()), pa.array([_squeeze(held[a:b])], pa.binary()),
                        pa.array([whole]),
                    ],
                    names=["bucket", "block", "keys", "kept", "held", "whole"],
                )

    return blocks.select("block", "folds", "lengths", "words", "tokens").mapInArrow(run, REQUESTS)


ANSWERS = "bucket int, block long, whole boolean, counts binary, n_kept long, v_kept long, n_all long, v_all long"


def tally(asked: DataFrame) -> DataFrame:
    """Sum the counts of each key of a bucket and answer every block; the first
    answer of a bucket also holds its numbers of tokens and distinct words."""

    def run(rows: pa.Table) -> pa.Table:
        keys = [_expand_sorted(k) for k in rows.column("keys").to_pylist()]
        told = [np.concatenate([_expand(c, "<u4") for c in rows.column(name).to_pylist()]) for name in ("kept", "held")]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        kept, held = (np.bincount(place, weights=counts).astype(np.int64) for counts in told)
        every = kept + held
        words = (distinct & np.uint64(1)) == 0
        whole = rows.column("whole").to_pylist()
        answers, at = [], 0
        for k, all_training in zip(keys, whole, strict=True):
            answers.append(_squeeze((every if all_training else kept)[place[at : at + len(k)]].astype("<u8")))
            at += len(k)
        sums = [kept[words].sum(), (kept[words] > 0).sum(), every[words].sum(), (every[words] > 0).sum()]
        rest = [0] * (len(keys) - 1)
        return pa.table({
            "bucket": rows.column("bucket"), "block": rows.column("block"), "whole": rows.column("whole"),
            "counts": pa.array(answers, pa.binary()),
            **{n: pa.array([int(s), *rest], pa.int64()) for n, s in zip(("n_kept", "v_kept", "n_all", "v_all"), sums, strict=True)},
        })

    return asked.groupBy("bucket").applyInArrow(run, ANSWERS)


def _with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with their answers in the order of buckets. A block's answers are as many as its entries."""
    joined = answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "counts"))).alias("answers"))
    return blocks.join(joined, "block")


def _counts(row: dict) -> np.ndarray:
    return np.concatenate([_expand(a["counts"], "<u8") for a in row["answers"]]).astype(np.int64)


def held_out_events(blocks: DataFrame, plan: Plan) -> DataFrame:
    """How often held-out runs occur, with the counts their estimates are made of:
    `word`, and for each order k from two `own_k` and `context_k`."""
    orders = range(2, plan.order + 1)
    names = ["times", "word", *[f"{name}_{k}" for k in orders for name in ("own", "context")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row, plan.order)
            word, found = block.per_run(*block.answered(_counts(row)))
            columns = [np.bincount(block.runs[-1].of), word, *[c for pair in found for c in pair]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return blocks.select("lengths", "words", "tokens", "answers").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def learned(events: DataFrame, n: int, v: int, plan: Plan) -> np.ndarray:
    """Weights (highest order first, zero last) of each context bucket by expectation-maximisation.

    A step is one aggregate over the events; only a row per bucket returns.
    A third of an observation per weight keeps all of them positive.
    """
    orders = range(plan.order, 1, -1)
    bits = lambda c: F.length(F.regexp_replace(F.bin(c), "^0$", ""))
    held = [F.when(F.col(f"context_{k}") > 0, (k - 2) * CONTEXTS + bits(f"context_{k}")) for k in orders]
    of = events.select(
        F.col("times").cast("double"), F.coalesce(*held, F.lit(0)).alias("bucket"),
        *[F.when(F.col(f"context_{k}") > 0, F.col(f"own_{k}") / F.col(f"context_{k}")).otherwise(F.lit(0.0)).alias(f"f{k}") for k in orders],
        (F.col("word") / F.lit(float(max(n, 1)))).alias("f1"),
    )
    estimates = [*[f"f{k}" for k in orders], "f1"]
    of = written(of.groupBy("bucket", *estimates).agg(F.sum("times").alias("times")), "events")
    width = plan.order + 1
    weights = np.full((CONTEXTS * (plan.order - 1), width), 1 / width)
    values = [*map(F.col, estimates), F.lit(1.0 / (v + 1))]
    for _ in range(plan.rounds):
        weight = [F.array(*map(F.lit, weights[:, k].tolist()))[F.col("bucket")] for k in range(width)]
        parts = of.select("bucket", "times", *[(a * f).alias(f"p{k}") for k, (a, f) in enumerate(zip(weight, values, strict=True))])
        total = reduce(lambda a, b: a + b, [F.col(f"p{k}") for k in range(width)])
        shares = [F.sum(F.col("times") * F.col(f"p{k}") / total).alias(f"p{k}") for k in range(width)]
        last, weights = weights, weights.copy()
        for row in parts.groupBy("bucket").agg(*shares).collect():
            expected = np.array(row[1:]) + 1 / 3
            weights[row["bucket"]] = expected / expected.sum()
        if np.abs(weights - last).max() < plan.settled:
            break
    return weights


SCORES = "key {key}, fold int, n_tokens long, n_known long, base_score double, score double"


def scores(blocks: DataFrame, weights: np.ndarray, n: int, v: int, plan: Plan) -> DataFrame:
    schema = StructType.fromDDL(SCORES.format(key=blocks.schema["keys"].dataType.elementType.simpleString()))
    key_type = to_arrow_schema(schema).field("key").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row, plan.order)
            words, known = block.answered(_counts(row))
            word, found = block.per_run(words, known)
            bucket = np.zeros(len(word), np.int64)
            for k, (_, context) in enumerate(found):  # the longest context that is held comes last
                bucket = np.where(context > 0, k * CONTEXTS + np.frexp(context.astype(np.float64))[1], bucket)
            p = weights[bucket, -2] * (word / max(n, 1)) + weights[bucket, -1] / (v + 1)
            for k, (own, context) in enumerate(reversed(found)):
                p += weights[bucket, k] * (own / np.maximum(context, 1))
            starts = np.cumsum([0, *row["lengths"][:-1]])
            per_doc = lambda values: np.add.reduceat(values, starts)  # noqa: B023, E731
            columns = [
                row["keys"], row["folds"], row["lengths"], per_doc((words > 0).astype(np.int64)[block.tokens]),
                per_doc(np.log10((words + 1) / (n + v + 1))[block.tokens]), per_doc(np.log10(p)[block.runs[-1].of]),
            ]
            types = [key_type, pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["key", "fold", "n_tokens", "n_known", "base_score", "score"],
            )

    return blocks.select("keys", "folds", "lengths", "words", "tokens", "answers").mapInArrow(run, schema)


def score(documents: DataFrame, plan: Plan = Plan(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks = written(encode(documents, plan, key, text), "blocks")
    held = written(encode(documents.filter(fold_of(key, plan) == plan.held), plan, key, text), "held")
    held = held.withColumn("block", -1 - F.col("block"))
    entries = blocks.agg(F.sum("n_entries")).first()[0] or 0
    bits = max(1, (int(entries) // plan.bucket_entries).bit_length())
    asked = requests(blocks, bits, plan, whole=True).union(requests(held, bits, plan, whole=False))
    answers = written(tally(asked), "answers")
    sums = answers.agg(*[F.sum(c) for c in ("n_kept", "v_kept", "n_all", "v_all")]).first()
    n_kept, v_kept, n_all, v_all = (int(s or 0) for s in sums)
    events = held_out_events(_with_answers(held, answers.filter("NOT whole")), plan)
    weights = learned(events, n_kept, v_kept, plan)
    found = scores(_with_answers(blocks, answers.filter("whole")), weights, n_all, v_all, plan)
    return found.select(
        F.col("key").alias(key), (F.col("fold") == plan.test).alias("held_out"), "n_tokens", "n_known",
        F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score",
    )
