"""Packing by vector bins: tokens, segments and loss-bearing tokens at once.

Every document becomes its token ids followed by an end id. What exceeds the
capacity is cut into full sequences; the rest of each document is an item with
a demand vector (tokens, segments, loss-bearing tokens). Bins are filled one
after the other by the dot-product heuristic: among the items that fit in all
dimensions, take the one whose demand has the largest dot product with the
bin's remaining capacity, both in units of capacity.

Items are packed within the batches of a task, where their tokens are made:
nothing is shuffled, work is linear in the batches, and a batch leaves one
badly filled bin. Items of equal demand are interchangeable, so a batch is a
histogram of demands and a step looks at distinct demands only.

Defined results: null and empty texts consist of the end id alone; repeated
rows are packed each; a batch without rows gives none; the string of an added
token of the vocabulary file is that token.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Fixed value: how a byte-level BPE of this family splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STRETCH = 1 << 20  # characters encoded at once
PIECES_AT_ONCE = 512  # handed on together


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Token ids by a byte-level BPE file of the tokenizers library.

    Merges are run by tiktoken, several times as fast, whose ranks are the ids
    of that file. With `added`, the file's added tokens are matched inside texts
    as the library does by default; without, their strings are plain text.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, tokens = whole["model"], whole.get("added_tokens", []) if added else []
        if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that take more or less than their own string")
        self.added = {t["content"]: t["id"] for t in tokens}
        # Longest first: of those that begin at one place the library takes the longest.
        longest = sorted(self.added, key=len, reverse=True)
        self.splits = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        letters, vocab = _byte_letters(), model["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        usable = {*merged, *(vocab[c] for c in letters)}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if i in usable}
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.added)

    def ids(self, text: str) -> np.ndarray:
        parts = []
        for k, piece in enumerate(self.splits.split(text) if self.splits else [text]):
            if k % 2:  # an added token, which no pre-token reaches over
                parts.append([self.added[piece]])
            else:
                parts.extend(self.encoding.encode_ordinary(stretch) for stretch in _stretches(piece))
        return np.concatenate([np.array(part, "<u4") for part in parts])

    def text(self, ids: np.ndarray) -> str:
        return self.encoding.decode(ids.tolist())


def _stretches(text: str) -> Iterator[str]:
    """The text in stretches that end where no pre-token reaches over: before a
    single space between two letters."""
    start = 0
    while len(text) - start > STRETCH:
        at = start + STRETCH
        while at < len(text) and not (text[at] == " " and text[at - 1].isalpha() and text[at + 1 : at + 2].isalpha()):
            at += 1
        yield text[start:at]
        start = at
    yield text[start:]


def pack(demands: np.ndarray, limits: Limits) -> list[list[int]]:
    """Bins of item numbers. demands: (items, 3), each within the limits."""
    capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.int64)
    waiting: dict[tuple[int, ...], list[int]] = defaultdict(list)
    bins: list[list[int]] = []
    for item, demand in enumerate(map(tuple, demands.tolist())):
        if demand[0] == limits.tokens:
            bins.append([item])  # full by itself
        else:
            waiting[demand].append(item)
    kinds = np.array(sorted(waiting, reverse=True), np.int64).reshape(-1, 3)
    left = np.array([len(waiting[tuple(k)]) for k in kinds.tolist()], np.int64)
    scaled = kinds / capacity
    while len(kinds):
        room, chosen = capacity.copy(), []
        while True:
            fits = (kinds <= room).all(axis=1) & (left > 0)
            if not fits.any():
                break
            k = int(np.argmax(np.where(fits, scaled @ (room / capacity), -1.0)))
            chosen.append(waiting[tuple(kinds[k].tolist())].pop())
            left[k] -= 1
            room -= kinds[k]
        bins.append(chosen)
        if (left == 0).sum() * 2 > len(left):
            keep = left > 0
            kinds, left, scaled = kinds[keep], left[keep], scaled[keep]
    return bins


PIECES = (
    "start long, length long, doc_tokens long, loss_tokens long, sequence_id long, offset long, "
    "segment int, ids binary"
)


def place(
    documents: DataFrame, tokenizer: str, text: str = "text", limits: Limits = Limits(), end_id: int = 0,
    loss: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """One row per piece, with the other columns of its document.

    ids: little-endian unsigned 32-bit integers. `loss(ids)` marks the
    loss-bearing ids of a document; by default all but the first one are, for
    nothing predicts that. Columns of the names added here are replaced.
    """
    new = StructType.fromDDL(PIECES)
    kept = documents.drop(text, *new.names)
    names, types = kept.columns, to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, added=True)
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            encoded, rows, starts, lengths, bearing = [], [], [], [], []
            for row, value in enumerate(batch.column(text)):
                ids = np.append(encoder.ids(value.as_py() or ""), np.uint32(end_id)).astype("<u4")
                mask = np.arange(len(ids)) > 0 if loss is None else loss(ids)
                upto = np.concatenate([[0], np.cumsum(mask)])
                encoded.append(ids)
                start = 0
                while start < len(ids):
                    within_loss = int(np.searchsorted(upto, upto[start] + limits.loss_tokens, side="right")) - 1
                    end = min(start + limits.tokens, within_loss, len(ids))
                    rows.append(row)
                    starts.append(start)
                    lengths.append(end - start)
                    bearing.append(int(upto[end] - upto[start]))
                    start = end
            demands = np.array([(n, 1, b) for n, b in zip(lengths, bearing, strict=True)], np.int64).reshape(-1, 3)
            order, places = [], []
            for chosen in pack(demands, limits):
                offset = 0
                for segment, p in enumerate(chosen):
                    order.append(p)
                    places.append((sequence, offset, segment))
                    offset += lengths[p]
                sequence += 1
            # Ids are copied for a few pieces at a time: copies of all would be several times the batch.
            for first in range(0, max(len(order), 1), PIECES_AT_ONCE):
                some = order[first : first + PIECES_AT_ONCE]
                placed = [list(c) for c in zip(*places[first : first + PIECES_AT_ONCE], strict=True)] or [[], [], []]
                columns = [
                    [starts[p] for p in some], [lengths[p] for p in some], [len(encoded[rows[p]]) for p in some],
                    [bearing[p] for p in some], *placed,
                ]
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, types, strict=False)]
                ids = pa.array([encoded[rows[p]][starts[p] : starts[p] + lengths[p]].tobytes() for p in some], pa.binary())
                taken = pa.array([rows[p] for p in some], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n).take(taken) for n in names], *arrays, ids], names=[*names, *types.names]
                )

    return documents.mapInArrow(run, StructType([*kept.schema.fields, *new.fields]))
