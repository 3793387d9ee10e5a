"""Quality rules whose limits adapt to each language and source.

Every document has metrics; for each (language, source, metric) a mergeable
quantile sketch is built: counts of logarithmic buckets (DDSketch), whose sums
merge exactly in any order and give each quantile within a relative error of
1 %. Limits are fences around the middle of a group's own distribution instead
of fixed cutoffs, and documents are filtered by joining them with the limits
of their group.

A fence is top + reach * max(top - quantile(1/2), slack), where top is
quantile(3/4), or a higher one for a metric that is zero in most documents: it
moves with what is usual in a group, and a group whose documents are all alike
does not reject the small differences among them; there slack alone rules.
Sketches count the documents that pass the base rules, as the others are
rejected whatever the limits. One rule holds for
sources of every size: to a source's sketch its language's is added as `prior`
documents at evenly spaced ranks, and before that everything's to each
language's. So a source of a few documents is judged by its language, and the
more it has, the more by its own, without a size at which that switches.

Sketches are ordinary partial sums: a source with a third of all rows arrives
at a reducer as one row per bucket and map task.

Defined results: a null text has no words and fails the base rules; null
languages and sources are groups of their own; repeated rows count and are
judged each; an empty table gives an empty result. Further columns pass
through, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import unused, with_text_columns, written

COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
)
GAMMA = 1.02  # bucket bounds grow by 2 %: quantiles within 1 %
SYMBOLS = "#*$%&|<>"  # fixed value


@dataclass(frozen=True)
class Metric:
    """A ratio of two counts; above its fence a document is rejected, and below
    the mirrored one as well if `both`. `slack` is in the unit of the ratio, `top`
    the quantile that the upper fence starts from."""

    name: str
    over: str
    under: str
    slack: float
    both: bool = False
    top: float = 0.75


METRICS = (
    Metric("mean_word_chars", "word_chars", "n_words", 0.3, both=True),
    Metric("symbols_per_word", "n_symbols", "n_words", 0.02),
    Metric("dup_line_share", "n_dup_lines", "n_lines", 0.1),
    Metric("repeat_share", "n_repeat_words", "n_words", 0.05, top=0.95),
)


@dataclass(frozen=True)
class Policy:
    reach: float = 5.0
    prior: int = 20  # documents that the coarser group's sketch counts as


def counts_of(text: str) -> tuple[int, int, int, int, int, int]:
    words = text.encode().split()  # of bytes: splits at ASCII white space only
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.encode().strip()]
    names: dict[bytes, int] = {}
    ids = [names.setdefault(w, len(names)) for w in words]
    seen: dict[tuple[int, int, int], int] = {}
    repeated = bytearray(len(ids))
    for at, window in enumerate(zip(ids, ids[1:], ids[2:], strict=False)):
        first = seen.setdefault(window, at)
        if first != at:
            repeated[first : first + 3] = repeated[at : at + 3] = b"\1\1\1"
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), sum(repeated)


def measured(documents: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """Every row with the counts of its whole text."""

    def make():
        return lambda texts: list(zip(*map(counts_of, texts), strict=True)) or [[]] * 6

    return with_text_columns(documents, text, make, COUNTS, drop_text)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(metric: Metric) -> Column:
    return F.coalesce(F.try_divide(F.col(metric.over).cast("double"), F.col(metric.under).cast("double")), F.lit(0.0))


def sketches(counts: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, metric, bucket, n): bucket null holds the zeros."""
    bucket = lambda m: F.when(
        _ratio(m) > 0, F.ceil(F.log(_ratio(m)) / F.lit(math.log(GAMMA))).cast("int")
    )
    each = F.array(*[F.struct(F.lit(m.name).alias("metric"), bucket(m).alias("bucket")) for m in METRICS])
    return (
        counts.filter(~base_failed()).select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(each).alias("m"))
        .groupBy("lang", "source", "m.metric", "m.bucket").agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """n, low quartile, median and the metric's upper quantile per group and
    metric. A group has as many rows as buckets, a few hundred."""
    top = F.create_map(*[F.lit(x) for m in METRICS for x in (m.name, m.top)])[F.col("metric")]
    group = Window.partitionBy(*keys, "metric")
    value = F.coalesce(F.pow(F.lit(GAMMA), F.col("bucket")) * (2 / (1 + GAMMA)), F.lit(0.0))
    ranked = sketch.withColumn("total", F.sum("n").over(group)).withColumn(
        "upto", F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first()))
    )
    at = lambda q, name: F.min(F.when(F.col("upto") >= q * F.col("total"), value)).alias(name)
    return ranked.groupBy(*keys, "metric").agg(
        F.first("total").alias("n"), at(0.25, "low"), at(0.5, "middle"), at(top, "high")
    )


def thinned(sketch: DataFrame, size: int, *keys: str) -> DataFrame:
    """The sketch of each group with `size` documents: those at evenly spaced ranks."""
    group = Window.partitionBy(*keys, "metric")
    below = lambda rank: F.expr(f"(2 * {size} * ({rank}) + total) div (2 * total)")
    ranked = sketch.withColumn("total", F.sum("n").over(group)).withColumn(
        "upto", F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first()))
    )
    return ranked.select(*keys, "metric", "bucket", (below("upto") - below("upto - n")).alias("n")).filter("n > 0")


def with_prior(sketch: DataFrame, coarse: DataFrame, size: int, keys: tuple[str, ...], shared: tuple[str, ...]) -> DataFrame:
    """`sketch` plus, for each of its groups, `size` documents of the group of
    `coarse` that has the same `shared` keys."""
    groups = sketch.select(*keys, "metric").distinct().alias("group")
    same = F.col("group.metric") == F.col("prior.metric")
    for key in shared:
        same = same & F.col(f"group.{key}").eqNullSafe(F.col(f"prior.{key}"))
    added = groups.join(thinned(coarse, size, *shared).alias("prior"), same).select("group.*", "prior.bucket", "prior.n")
    return merged(sketch.unionByName(added), *keys)


def limits(sketch: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One row per language and source: fences of every metric."""
    by_lang = with_prior(merged(sketch, "lang"), merged(sketch), policy.prior, ("lang",), ())
    own = with_prior(sketch, by_lang, policy.prior, ("lang", "source"), ("lang",))
    rows = quantiles(own, "lang", "source")
    slack = F.create_map(*[F.lit(x) for m in METRICS for x in (m.name, m.slack)])[F.col("metric")]
    fenced = rows.select(
        "lang", "source", "metric",
        (F.col("high") + policy.reach * F.greatest(F.col("high") - F.col("middle"), slack)).alias("above"),
        (F.col("low") - policy.reach * F.greatest(F.col("middle") - F.col("low"), slack)).alias("below"),
    )
    wide = [
        F.max(F.when(F.col("metric") == m.name, F.col(c))).alias(f"{m.name}_{c}")
        for m in METRICS for c in (("above", "below") if m.both else ("above",))
    ]
    return fenced.groupBy("lang", "source").agg(*wide)


def fences(counts: DataFrame, lang: str = "lang", source: str = "source", policy: Policy = Policy()) -> DataFrame:
    """The limits as a written table, whose size Spark knows when it plans the
    join: a small one is broadcast, a large one joined by sort and merge. The
    sketches are written too, for limits read them several times."""
    return written(limits(written(sketches(counts, lang, source), "sketches"), policy), "fences")


def judge(counts: DataFrame, fenced: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows of `measured` with base_failed and kept, which replace columns of these names."""
    counts = counts.drop("base_failed", "kept")
    # Fences take names that clash with no column of the rows.
    names = {c: unused(counts, f"_fence_{c}") for c in fenced.columns}
    joined = counts.join(
        fenced.withColumnsRenamed(names),
        F.col(lang).eqNullSafe(F.col(names["lang"])) & F.col(source).eqNullSafe(F.col(names["source"])),
        "left",
    )
    verdict = F.lit(True)
    for m in METRICS:
        verdict = verdict & (_ratio(m) <= F.col(names[f"{m.name}_above"]))
        if m.both:
            verdict = verdict & (_ratio(m) >= F.col(names[f"{m.name}_below"]))
    failed = base_failed()
    return joined.select(
        *[F.col(c) for c in counts.columns], failed.alias("base_failed"), (~failed & verdict).alias("kept")
    )
