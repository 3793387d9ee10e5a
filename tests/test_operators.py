import math
import random
from datetime import date
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from commerce_lake.operators.bitmaps import daily_bitmaps, distinct_ids
from commerce_lake.operators.prefix import running_sums
from commerce_lake import bindings
from commerce_lake.functions import dates, labels, numbers, text
from commerce_lake.operators.percentiles import exact_percentiles
from commerce_lake.operators.ranking import first_per_group, ranked
from commerce_lake.operators.shares import grand_total, in_one_row, running_share, share_of_groups
from commerce_lake.operators.sketches import digit_counts, merged, quantile_bounds

POINTS = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1]


def _skewed(n=3000, seed=7):
    """A third of the rows share one key; values repeat heavily."""
    rng = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{rng.randrange(20)}", round(rng.gauss(0, 50), 1)) for i in range(n)]


@pytest.mark.parametrize("interpolate", [True, False])
@pytest.mark.parametrize("width", [0.5, 10.0, 1000.0])
def test_percentiles_match_brute_force(spark, interpolate, width):
    rows = _skewed() + [("hot", None), (None, 4.0), (None, 8.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: list(r)[1:] for r in exact_percentiles(df, ["k"], "v", POINTS, width, interpolate).collect()}
    method = "linear" if interpolate else "inverted_cdf"
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key and v is not None]
        expected = [np.quantile(values, p, method=method) for p in POINTS]
        assert np.allclose(found[key], expected, rtol=0, atol=1e-9), key


def test_percentile_without_keys_and_of_decimals(spark):
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("2.50"),)], "v decimal(18,2)")
    assert exact_percentiles(df, [], "v", [0.5], Decimal("1")).first().p0 == 1.75
    empty = exact_percentiles(df.limit(0), [], "v", [0.5], Decimal("1")).first()
    assert empty.p0 is None


def test_ranking_matches_brute_force_on_a_hot_key(spark):
    rows = [(k, v, i) for i, (k, v) in enumerate(_skewed())]
    df = spark.createDataFrame(rows, "k string, v double, i int").repartition(6)
    order = [F.desc("v"), F.col("i")]
    found = {(r.k, r.place): r.i for r in ranked(df, ["k"], order, 3, "place").collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))[:3]
        expected |= {(key, n + 1): r[2] for n, r in enumerate(best)}
    assert found == expected
    firsts = {r.k: r.i for r in first_per_group(df, ["k"], order).collect()}
    assert firsts == {k: i for (k, n), i in expected.items() if n == 1}


def test_shares_and_one_row(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n int")
    shares = {r.k: r.pct for r in df.withColumn("pct", share_of_groups("n", 1)).collect()}
    assert shares == {"a": 25.0, "b": 75.0}
    scalar = {r.k: r.x for r in df.select("k", (F.col("n") / grand_total(df, "n")).alias("x")).collect()}
    assert scalar == {"a": 0.25, "b": 0.75}
    running = df.withColumn("r", running_share("n", [F.desc("n")]))
    assert {r.k: r.r for r in running.collect()} == {"b": 3.0, "a": 4.0}
    tie = spark.createDataFrame([(4.1, 1), (3.85, 2)], "x double, i int").withColumn("r", running_share("x", [F.col("i")]))
    assert [r.r for r in tie.orderBy("i").collect()] == [4.1, 8.0]
    row = in_one_row(df.agg(F.max("k").alias("k")), df.agg(F.sum("n").alias("n"))).first()
    assert (row.k, row.n) == ("b", 4)


def test_label_splitting_uses_the_last_separator(spark):
    df = spark.createDataFrame([("a / b / SP",), ("plain",), (" / X",)], "s string")
    found = [tuple(r) for r in df.select(text.label_head("s"), text.label_tail("s")).collect()]
    expected = [tuple(s.rsplit(" / ", 1)) if " / " in s else (s, s) for s in ("a / b / SP", "plain", " / X")]
    assert found == expected


def test_elapsed_days_truncate_toward_zero(spark):
    df = spark.sql(
        """SELECT timestamp'2020-01-01 00:00:00' AS a, timestamp'2020-01-01 01:01:00' AS b"""
    )
    row = df.select(dates.elapsed_days("a", "b").alias("up"), dates.elapsed_days("b", "a").alias("down")).first()
    assert (row.up, row.down) == (1 / 24, -1 / 24)


def test_buckets_at_their_limits(spark):
    df = spark.createDataFrame([(d,) for d in (0, 1, 3, 4, 7, 8, 15, 16)], "d int")
    late = [r[0][0] for r in df.select(labels.lateness(F.col("d") > 0, F.col("d"))).collect()]
    assert late == ["0", "1", "1", "2", "2", "3", "3", "4"]
    df = spark.createDataFrame([(d,) for d in (180, 181, 365, 366, 540, 541)], "d int")
    old = [r[0] for r in df.select(labels.recency(F.col("d"))).collect()]
    assert old == ["0-180 days", "181-365 days", "181-365 days", "366-540 days", "366-540 days", "540+ days"]


def test_tolerant_timestamp(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00",), ("soon",), (None,)], "s string")
    assert [r[0] is None for r in df.select(dates.tolerant_timestamp("s")).collect()] == [False, True, True]


@pytest.mark.parametrize("rows", [[], [(1, None, 3)], [(k, None if k % 11 == 0 else (k * 37) % 101, k % 3) for k in range(700)]])
def test_running_sums(spark, rows):
    df = spark.createDataFrame(rows, "k long, v long, _part_ long")
    found = running_sums(df.repartition(6), [F.col("v").asc_nulls_last(), F.col("k")], {"so_far": "v", "n": "k"})
    total, n, expected = None, None, []
    for k, v, other in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0])):
        total = total if v is None else (total or 0) + v
        n = (n or 0) + k
        expected.append((k, v, other, total, n))
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_bitmaps_merge_to_exact_distinct_counts(spark):
    rows = [(date(2024, 1, 1 + k % 5), (k * k) % 90_001 - 1000 * (k % 2)) for k in range(4000)] + [(date(2024, 1, 1), None), (None, 7)]
    rows += [(date(2024, 1, 3), 42)] * 3000  # a hot id
    daily = daily_bitmaps(spark.createDataFrame(rows, "d date, id long"), F.col("d"), F.col("id"))
    for days in ({1}, {1, 2}, {3, 4, 5}, {1, 2, 3, 4, 5}):
        some = daily.where(F.dayofmonth("day").isin(*days)).withColumn("all", F.lit(1))
        expected = len({i for d, i in rows if d and d.day in days and i is not None})
        assert distinct_ids(some, ["all"], "n").first()["n"] == expected


def _exact(values, p):
    return sorted(values)[max(math.ceil(Fraction(str(p)) * len(values)), 1) - 1]


def test_sketch_bounds_hold_the_exact_quantiles(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else rng.choice("abc"), i % 7, int(rng.gauss(0, 1) * 10 ** rng.randrange(12))) for i in range(4000)]
    rows += [(None, 0, -1000), (None, 1, -999), (None, 2, 0), ("void", 1, None), ("big", 0, 2**63 - 1), ("big", 0, -(2**63))]
    df = spark.createDataFrame(rows, "k string, day int, v long")
    points = [0, 0.01, 0.25, 0.5, 0.9, 1]
    daily = digit_counts(df, ["day", "k"], F.col("v"))
    found = quantile_bounds(merged(daily, ["k"]), ["k"], points).collect()
    once = quantile_bounds(digit_counts(df, ["k"], F.col("v")), ["k"], points).collect()
    assert sorted(found, key=str) == sorted(once, key=str)
    groups = {}
    for k, _, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert {(r.k, r.p) for r in found} == {(k, float(p)) for k in groups for p in points}
    for r in found:
        values = groups[r.k]
        assert r.low <= _exact(values, r.p) <= r.high and r.total == len(values)
        # The ranks are those of the values between the bounds, no others.
        assert r.rank_low == 1 + sum(v < r.low for v in values) and r.rank_high == sum(v <= r.high for v in values)
        assert r.high - r.low <= max(abs(r.low), abs(r.high)) / 100


def test_sketch_of_no_values(spark):
    df = spark.createDataFrame([("a", None)], "k string, v long")
    assert quantile_bounds(digit_counts(df, ["k"], F.col("v")), ["k"], [0.5]).count() == 0


def test_money_is_what_a_cast_gives(spark):
    rng = random.Random(5)
    odd = [None, 0.0, -0.0, 0.005, 0.015, 1.005, 2.675, -1.005, 0.1 + 0.2, 9.995, 1e-300, 123456789012.34, 9999999999999.99, 1e13 + 0.01, 4e15, -9.99e15]
    cents = [rng.randrange(-10**n, 10**n) / 100 for n in (3, 6, 9, 12, 15) for _ in range(60)]
    values = odd + cents + [math.nextafter(c, math.inf) for c in cents] + [rng.uniform(-1e6, 1e6) for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    made = df.select("v", numbers.to_money("v").alias("made"), F.col("v").cast(numbers.MONEY).alias("cast"))
    assert made.schema["made"].dataType == numbers.MONEY
    assert not made.where("NOT (made <=> cast)").collect()
    texts = spark.createDataFrame([("12.345",), (" 7 ",), (None,)], "v string").select(numbers.money("v"))
    assert [r.v for r in texts.collect()] == [Decimal("12.35"), Decimal("7.00"), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("fifty",)], "v string").select(numbers.money("v")).collect()


def test_cents_are_what_rounding_gives(spark):
    rng = random.Random(6)
    values = [None, 0.005, 0.015, -0.005, 1.125, -1.125, 0.125, 2.5, 90071992547409.92, 1e16] + [rng.uniform(-1e5, 1e5) for _ in range(500)]
    values += [rng.randrange(-10**8, 10**8) / 8 for _ in range(200)]  # many halves of a cent
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cents = df.select("v", F.expr(bindings._cents("v")).alias("made"), F.expr("cast(round(v * 100) as bigint)").alias("plain"))
    assert not cents.where("NOT (made <=> plain)").collect()


def test_white_space_at_the_last_byte(spark):
    space = text.WHITE_SPACE
    values = ["a", "a ", "é", "aé", "a ", "a b", " a", "a\u0085", "日本", "a日", "a\x7f", "a\x1f", "", " ", None, "x\U0001f600"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r.s for r in df.select(text.stripped("v").alias("s")).collect()]
    assert found == [v if v is None else v.strip(space) for v in values]
