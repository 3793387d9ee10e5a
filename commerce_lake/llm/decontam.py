"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

An item is a sequence of windows of `window` words (a shorter item is one
window), a window a set of word shingles at fixed offsets. A document contains
a window exactly if it has the window's words in a row, so it must have all of
its shingles. Shingles are ordered by rarity, their count over the documents;
of a set that must be contained whole, the necessary prefix is the one rarest
shingle. The join is on prefix shingles alone. A match at a position fixes
where the window would begin: bounds on position and length drop what would
reach over either end, and the words around the position verify the rest.

Documents are read once. A bit filter over all benchmark shingles, between
8 KB and 16 MB by their number, keeps only the positions that may matter;
what it lets through by chance, the join drops. Those positions with the few
words around them are written to the shared folder, so rarity counts, joins
and verification read a small table.

Defined results: null and empty texts have no words and no hits; items
without words never occur; equal windows of several items count for each
item; in `find` repeated rows of one doc_id each carry the hits of that id, in
`find_in_rows` those of their own text; items with a null id count but cannot
be listed. Further columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 5
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 21  # of 64 bits, in the filter
BITS_PER_SHINGLE = 32


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _shingle_at(array: str, at: str, length: int) -> str:
    """SQL for the hash of `length` words from the 0-based place `at`."""
    return f"xxhash64({', '.join([str(length), *[f'{array}[{at} + {k}]' for k in range(length)]])})"


def windows_of(benchmark: DataFrame, window: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, wid, wwords): every window of every item; wid is a digest of the words."""
    items = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = items.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("wwords"))
    return each.select("item", F.sha2(F.array_join("wwords", " "), 256).alias("wid"), "wwords").distinct()


def shingles_of(windows: DataFrame, shingle: int) -> DataFrame:
    """(wid, wwords, o, h): a distinct window's shingles with their offsets from 0.
    A window of fewer words is its own only shingle."""
    distinct = windows.select("wid", "wwords").distinct()
    full = distinct.filter(F.size("wwords") >= shingle).select(
        "wid", "wwords",
        F.expr(
            f"posexplode(transform(sequence(0, size(wwords) - {shingle}), i -> {_shingle_at('wwords', 'i', shingle)}))"
        ).alias("o", "h"),
    )
    for length in range(1, shingle):
        short = distinct.filter(F.size("wwords") == length)
        full = full.unionByName(
            short.select("wid", "wwords", F.lit(0).alias("o"), F.expr(_shingle_at("wwords", "0", length)).alias("h"))
        )
    return full


def bit_filter(shingles: DataFrame) -> tuple[Column, int]:
    """A Bloom filter of one bit per shingle as an array column, and its number of 64-bit words."""
    n = shingles.select(F.count_distinct("h")).first()[0]
    size = LEAST_WORDS
    while size < MOST_WORDS and size * 64 < n * BITS_PER_SHINGLE:
        size *= 2
    bits = (
        shingles.select(F.expr(f"shiftrightunsigned(h, 6) & {size - 1}").cast("int").alias("slot"), F.expr("shiftleft(1L, cast(h & 63 AS int))").alias("bit"))
        .unionByName(shingles.sparkSession.range(size).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("long").alias("bit")))
        .groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    )
    packed = bits.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "bits"))), lambda s: s["bits"]).alias("bits"))
    return packed.scalar(), size


def positions(
    documents: DataFrame, shingles: DataFrame, window: int, shingle: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_words, hits): one row per document with the positions whose
    shingle may be one of the benchmark's, from 0, and the words around them."""
    bits, size = bit_filter(shingles)
    # Lengths of short windows that occur at all: at most shingle - 1 values.
    short = sorted(
        r[0] for r in shingles.select(F.size("wwords")).distinct().filter(F.size("wwords") < shingle).collect()
    )
    reach = window - 1  # words a window may have before or after a position
    rows = documents.select(F.col(key).alias("key"), words(F.col(text)).alias("w")).withColumn("bits", bits)
    found = []
    for length in [*short, shingle]:
        hashed = f"transform(sequence(0, size(w) - {length}), i -> struct(i AS p, {_shingle_at('w', 'i', length)} AS h))"
        passing = f"filter({hashed}, x -> (shiftrightunsigned(bits[cast(shiftrightunsigned(x.h, 6) & {size - 1} AS int)], cast(x.h & 63 AS int)) & 1) = 1)"
        found.append(f"if(size(w) >= {length}, {passing}, array())")
    around = (
        f"transform(concat({', '.join(found)}), x -> struct(x.p AS p, x.h AS h, greatest(x.p - {reach}, 0) AS c, "
        f"slice(w, greatest(x.p - {reach}, 0) + 1, {2 * reach + 1}) AS around))"
    )
    return rows.select("key", F.size("w").cast("long").alias("n_words"), F.expr(around).alias("hits"))


def contained(found: DataFrame, shingles: DataFrame) -> DataFrame:
    """(key, start, length, wid): every occurrence of a window, verified."""
    at = found.select("key", "n_words", F.explode("hits").alias("x")).select("key", "n_words", "x.*")
    rarity = at.groupBy("h").agg(F.count("*").alias("n"))
    ranked = shingles.join(rarity, "h", "left").withColumn(
        "rank", F.row_number().over(Window.partitionBy("wid").orderBy(F.coalesce("n", F.lit(0)), "o"))
    )
    prefixes = written(ranked.filter("rank = 1").select("h", "wid", "wwords", "o"), "prefixes")
    begin = F.col("p") - F.col("o")
    length = F.size("wwords")
    inside = (begin >= 0) & (begin + length <= F.col("n_words"))
    same = F.expr("slice(around, p - o - c + 1, size(wwords)) = wwords")
    return (
        at.join(prefixes, "h").filter(inside).filter(same)
        .select("key", begin.alias("start"), length.alias("length"), "wid").distinct()
    )


def find(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = SHINGLE,
    key: str = "doc_id", item: str = "item_id", text: str = "text",
) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, item_ids (sorted as strings)."""
    windows = written(windows_of(benchmark, window, item, text), "windows")
    shingles = written(shingles_of(windows, shingle), "shingles")
    found = written(positions(documents, shingles, window, shingle, key, text), "positions")
    occurrences = written(contained(found.filter(F.size("hits") > 0), shingles), "occurrences")
    hit = occurrences.select("key", F.explode(F.sequence("start", F.expr("start + length - 1"))).alias("p"))
    hits = hit.groupBy("key").agg(F.count_distinct("p").alias("n_hit"))
    items = (
        occurrences.select("key", "wid").distinct().join(windows.select("wid", "item"), "wid").select("key", "item").distinct()
        .groupBy("key").agg(
            F.count("*").alias("n_items"),
            F.array_sort(F.collect_list(F.col("item").cast("string"))).alias("item_ids"),
        )
    )
    documents = found.select("key", "n_words")
    per_key = hits.alias("h").join(items.alias("i"), F.col("h.key").eqNullSafe(F.col("i.key"))).select("h.*", "i.n_items", "i.item_ids")
    return (
        documents.alias("d").join(per_key.alias("f"), F.col("d.key").eqNullSafe(F.col("f.key")), "left")
        .select(
            F.col("d.key").alias(key), "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.expr("cast(array() AS array<string>)")).alias("item_ids"),
        )
    )


def find_in_rows(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """As `find`, but rows of one id are told apart by their texts, so each has
    the hits of its own text, rows of a null id too."""
    rows = documents.select(F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("hash")).alias("row"), F.col(text).alias("text"))
    found = find(rows, benchmark, key="row", text="text", **more)
    return found.select(F.col("row.id").alias(key), *[c for c in found.columns if c != "row"])
