"""Secret scans through a trigram inverted index.

For every rule a Boolean trigram query is derived from the parse tree of its
regular expression: an AND over clauses, each an OR over sets of trigrams that
must all be present. Each block of documents gets an inverted index of the
trigrams that queries mention (trigram -> sorted rows), postings are
intersected and united by the query, and only the candidates are matched
against the expression. Rules without a mandatory trigram scan the block in
full. Trigrams are taken over UTF-8 bytes with A-Z folded, so the index never
loses a candidate whatever case a rule accepts.

A block is one batch of a task: the index is built and used where the texts
are, nothing is shuffled, no posting list outgrows a batch, and a lost task
repeats only its own split.

Defined results: null and empty texts have no spans; repeated rows each get
their own result; other columns pass through. Offsets are code points, end
exclusive; spans are ordered by start, then by rule as listed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import with_text_columns

SPANS = "array<struct<kind:string,start:int,end:int>>"
MOST_STRINGS = 64  # alternatives followed exactly; beyond, a part counts as unknown, which keeps more candidates

Clause = tuple[frozenset[bytes], ...]


@dataclass(frozen=True)
class Rule:
    """A named expression; matches whose `group` is shorter than `least` are dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Published token formats.
RULES = (
    *BASE_RULES,
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("connection", r"[a-z][a-z0-9+]{2,15}://[A-Za-z0-9._-]{1,64}:[^\s:@/]{3,64}@[A-Za-z0-9.-]+"),
)


def _clause(strings: set[bytes]) -> list[Clause]:
    """What the presence of one of the strings demands; nothing if one is too short."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    least = [s for s in sets if not any(other < s for other in sets)]  # what contains another adds nothing to an OR
    return [] if frozenset() in sets else [tuple(sorted(least, key=sorted))]


class _Deriver:
    """Walks a parse tree, keeping the strings the current stretch may spell."""

    def __init__(self) -> None:
        self.stretch: set[bytes] = {b""}
        self.clauses: list[Clause] = []

    def flush(self) -> None:
        self.clauses += _clause(self.stretch)
        self.stretch = {b""}

    def append(self, strings: set[bytes]) -> None:
        if len(self.stretch) * len(strings) > MOST_STRINGS:
            self.flush()
        if len(strings) > MOST_STRINGS:
            self.flush()
        else:
            self.stretch = {a + b for a, b in product(self.stretch, strings)}

    def walk(self, tree) -> None:
        for kind, value in tree:
            if kind is op.SUBPATTERN:
                self.walk(value[3])
            elif (strings := _strings([(kind, value)])) is not None:
                self.append(strings)
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
                strings = _strings(value[2])
                if strings is None:
                    self.flush()
                    self.walk(value[2])
                elif len(strings) ** value[0] <= MOST_STRINGS:
                    for _ in range(value[0]):
                        self.append(strings)
                self.flush()
            elif kind is op.BRANCH:
                self.flush()
                options = [derive_tree(branch) for branch in value[1]]
                if all(options):  # one clause of each branch: weaker than all of them, and never wrong
                    self.clauses.append(tuple(s for clauses in options for s in clauses[0]))
            elif kind is not op.AT:
                self.flush()


def _strings(tree) -> set[bytes] | None:
    """All strings a subtree spells, with A-Z folded; None if unknown or too many."""
    spelled = {b""}
    for kind, value in tree:
        if kind is op.LITERAL:
            part = {chr(value).encode().lower()}
        elif kind is op.IN:
            part = set()
            for inner, chosen in value:
                if inner is op.LITERAL:
                    part.add(chr(chosen).encode().lower())
                elif inner is op.RANGE and chosen[1] - chosen[0] < 8:
                    part |= {chr(c).encode().lower() for c in range(chosen[0], chosen[1] + 1)}
                else:
                    return None
        elif kind is op.SUBPATTERN:
            part = _strings(value[3])
        elif kind is op.BRANCH:
            options = [_strings(branch) for branch in value[1]]
            part = None if None in options else set().union(*options)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[:2] == (0, 1):
            inner = _strings(value[2])
            part = None if inner is None else inner | {b""}
        else:
            return None
        if part is None or len(part) * len(spelled) > MOST_STRINGS:
            return None
        spelled = {a + b for a, b in product(spelled, part)}
    return spelled


def derive_tree(tree) -> list[Clause]:
    deriver = _Deriver()
    deriver.walk(tree)
    deriver.flush()
    return deriver.clauses


def derive(rule: Rule) -> list[Clause]:
    """The Boolean trigram query of a rule; empty if it has no mandatory trigram."""
    return derive_tree(parser.parse(rule.pattern, rule.flags))


class BlockIndex:
    """Trigram -> sorted rows, over a block of texts, for the trigrams asked for."""

    def __init__(self, texts: list[str], slots: np.ndarray, trigrams: list[bytes]) -> None:
        self.n = len(texts)
        self.postings: dict[bytes, np.ndarray] = {t: np.empty(0, np.int64) for t in trigrams}
        pieces = [t.encode().lower() for t in texts]
        step = 4 << 20  # bytes indexed at once
        first, row = 0, 0
        found = []
        while row < len(pieces):
            size = 0
            while row < len(pieces) and (size == 0 or size + len(pieces[row]) < step):
                size += len(pieces[row]) + 3
                row += 1
            # Three NULs between texts: no listed trigram spans two of them.
            data = np.frombuffer(b"\0\0\0".join(pieces[first:row]) + b"\0\0\0", np.uint8)
            codes = data[:-2].astype(np.int32)
            codes <<= 8
            codes |= data[1:-1]
            codes <<= 8
            codes |= data[2:]
            slot = slots[codes]
            at = np.flatnonzero(slot)
            starts = np.cumsum([0, *[len(p) + 3 for p in pieces[first:row]]])
            rows = np.searchsorted(starts, at, side="right") - 1 + first
            found.append(np.unique(slot[at].astype(np.int64) * len(pieces) + rows))
            first = row
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        which, rows = np.divmod(pairs, max(self.n, 1))
        for k in np.unique(which):
            self.postings[trigrams[k - 1]] = rows[which == k]

    def candidates(self, query: list[Clause]) -> np.ndarray:
        if not query:
            return np.arange(self.n)
        none = np.empty(0, np.int64)
        intersected = lambda lists: reduce(np.intersect1d, sorted(lists, key=len))
        clauses = [
            reduce(np.union1d, [intersected([self.postings.get(t, none) for t in option]) for option in clause])
            for clause in query
        ]
        return intersected(clauses)


def make_scanner(rules: tuple[Rule, ...] = RULES):
    queries = [derive(rule) for rule in rules]
    compiled = [re.compile(rule.pattern, rule.flags) for rule in rules]
    trigrams = sorted({t for query in queries for clause in query for option in clause for t in option})
    # 2^24 entries, one per possible trigram: 0, or its place in the list from 1.
    slots = np.zeros(1 << 24, np.uint16)
    for k, t in enumerate(trigrams, 1):
        slots[int.from_bytes(t, "big")] = k

    def scan(texts: list[str]) -> list[list[tuple[int, int, str, int]]]:
        index = BlockIndex(texts, slots, trigrams)
        spans: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
        for order, (rule, query, pattern) in enumerate(zip(rules, queries, compiled, strict=True)):
            for row in index.candidates(query):
                for match in pattern.finditer(texts[row]):
                    a, b = match.span(rule.group)
                    if b - a >= rule.least:
                        spans[row].append((match.start(), order, rule.kind, match.end()))
        return [sorted(s) for s in spans]

    return scan


def find(documents: DataFrame, text: str = "text", spans: str = "spans", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row with the spans of its secrets; its text stays."""

    def make():
        scan = make_scanner(rules)
        return lambda texts: [
            [[{"kind": k, "start": a, "end": b} for a, _, k, b in found] for found in scan(texts)]
        ]

    return with_text_columns(documents, text, make, f"{spans} {SPANS}")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each stretch of overlapping spans replaced by `mark`.

    A fold over the spans, ordered by start: what lies between them is kept.
    """
    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(acc: Column, span: Column) -> Column:
        fresh = span["start"] >= acc["at"]
        # A touching or overlapping span only moves the end.
        kept = F.when(fresh, F.concat(acc["done"], text.substr(acc["at"] + 1, span["start"] - acc["at"]), F.lit(mark)))
        return F.struct(
            kept.otherwise(acc["done"]).alias("done"), F.greatest(acc["at"], span["end"]).alias("at")
        )

    rest = lambda acc: F.concat(acc["done"], text.substr(acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, begin, step, rest))
