from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from commerce_lake.sources import landing, versions
from commerce_lake.sources.contract import ContractError, header_of, missing_files, scan, scan_all
from commerce_lake.sources.findings import findings
from commerce_lake.sources.schema import RAW_TABLES, DeclarationError, declare, with_file_prefix
from commerce_lake.sources.storage import (
    Lake, publish, refresh_days, replace_days, to_client, write_clustered, write_partitioned, write_table,
)
from commerce_lake.sources.zorder import _range_of, interleaved, range_ends, write_zordered

NOW = datetime(2024, 5, 1, 12)


def _entry(**changes):
    return {"table": "t", "file": "t.csv", "columns": {"a": "text"}} | changes


def test_declared_tables_have_52_nullable_columns():
    assert len(RAW_TABLES) == 9
    fields = [f for t in RAW_TABLES.values() for f in t.schema.fields]
    assert len(fields) == 52 and all(f.nullable for f in fields)
    assert [f.dataType.simpleString() for f in RAW_TABLES["order_items"].schema.fields] == [
        "string", "bigint", "string", "string", "timestamp", "double", "double",
    ]


@pytest.mark.parametrize(
    "entries, named",
    [
        ([_entry(columns={"a": "text", "b": "varchar"})], "t.b"),
        ([_entry(flavour="x")], "flavour"),
        ([_entry(), _entry()], "`t` is declared twice"),
        ([_entry(columns={})], "columns"),
        ([{"table": "t", "columns": {"a": "text"}}], "file"),
    ],
)
def test_bad_declarations_name_the_offender(entries, named):
    with pytest.raises(DeclarationError, match=named):
        declare(entries)


def test_scan_round_trip_keeps_types_zeros_blanks_and_line_breaks(spark, raw, incoming):
    scanned = scan_all(spark, str(incoming))
    for name, df in scanned.items():
        assert df.schema == RAW_TABLES[name].schema, name
    for name in ("orders", "order_items", "products", "geolocation"):
        assert scanned[name].count() == raw[name].count()
    assert scanned["customers"].where("customer_zip_code_prefix = '01234'").count() == 4
    assert scanned["orders"].where("order_delivered_customer_date is null").count() == 3
    messages = [r[0] for r in scanned["order_reviews"].where("order_id = 'o1'").select("review_comment_message").collect()]
    assert messages == ['great\n"really", great']


def test_all_null_column_keeps_its_type(spark, raw, tmp_path):
    empty = raw["orders"].withColumn("order_delivered_customer_date", F.lit(None).cast("timestamp"))
    empty.write.option("header", True).csv(str(tmp_path / RAW_TABLES["orders"].file))
    scanned = scan(spark, str(tmp_path), RAW_TABLES["orders"])
    assert scanned.schema["order_delivered_customer_date"].dataType.simpleString() == "timestamp"
    assert scanned.where("order_delivered_customer_date is not null").count() == 0


def _offer(df, folder, table):
    df.write.option("header", True).csv(str(folder / RAW_TABLES[table].file))


def test_undeclared_column_fails_the_first_load_by_name(spark, raw, tmp_path):
    _offer(raw["customers"].withColumn("loyalty_tier", F.lit("gold")), tmp_path, "customers")
    with pytest.raises(ContractError, match="loyalty_tier"):
        scan(spark, str(tmp_path), RAW_TABLES["customers"])


def test_missing_and_reordered_columns_are_named(spark, raw, tmp_path):
    _offer(raw["customers"].drop("customer_city"), tmp_path, "customers")
    with pytest.raises(ContractError, match="customer_city"):
        scan(spark, str(tmp_path), RAW_TABLES["customers"])
    _offer(raw["sellers"].select("seller_state", "seller_id", "seller_city", "seller_zip_code_prefix"), tmp_path, "sellers")
    with pytest.raises(ContractError, match="order"):
        scan(spark, str(tmp_path), RAW_TABLES["sellers"])


def test_value_of_the_wrong_type_fails_the_load(spark, raw, tmp_path):
    spoiled = raw["order_items"].withColumn("price", F.lit("fifty-eight"))
    _offer(spoiled, tmp_path, "order_items")
    # The spoiled column is not asked for, and checked all the same.
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        scan(spark, str(tmp_path), RAW_TABLES["order_items"]).select("order_id").collect()


@pytest.mark.parametrize("later, said", [
    ("seller_id,seller_zip_code_prefix,seller_city,seller_state,loyalty_tier\na,1,b,SP,x\n", "expects 4 columns, found 5"),
    ("seller_id,seller_zip_code_prefix,seller_city,loyalty_tier\na,1,b,SP\n", "expects column seller_state, found loyalty_tier"),
    ("seller_id,seller_city,seller_zip_code_prefix,seller_state\na,b,1,SP\n", "expects column seller_zip_code_prefix, found seller_city"),
    ("seller_id,seller_zip_code_prefix,seller_city,seller_state\na,1,b,SP,EXTRA\n", "alformed"),
])
def test_a_later_part_that_differs_is_not_landed(spark, raw, tmp_path, later, said):
    only = {"sellers": RAW_TABLES["sellers"]}
    _offer(raw["sellers"], tmp_path, "sellers")
    (tmp_path / RAW_TABLES["sellers"].file / "part-99999.csv").write_text(later)
    with pytest.raises(ContractError, match=said) as error:
        landing.land(spark, str(tmp_path), str(tmp_path / "zone"), date(2024, 5, 1), NOW, only)
    assert "sellers_dataset.csv" in str(error.value)


def test_refused_load_leaves_the_last_one(spark, raw, tmp_path):
    only = {"order_items": RAW_TABLES["order_items"]}
    _offer(raw["order_items"], tmp_path / "good", "order_items")
    _offer(raw["order_items"].withColumn("price", F.lit("fifty-eight")), tmp_path / "bad", "order_items")
    target = str(tmp_path / "raw")
    landing.load(spark, str(tmp_path / "good"), target, "a", NOW, only)
    with pytest.raises(ContractError, match="order_items_dataset.csv"):
        landing.load(spark, str(tmp_path / "bad"), target, "b", NOW, only)
    kept = landing.read_raw(spark, target, only)["order_items"]
    assert kept.count() == raw["order_items"].count()
    assert {r.load_id for r in kept.select("load_id").distinct().collect()} == {"a"}
    row = landing.load_freshness(spark, target, NOW.replace(day=4)).first()
    assert (row.age_hours, row.status) == (72.0, "warn")


def test_a_column_listed_twice_is_refused():
    with pytest.raises(DeclarationError, match="t.a"):
        declare([_entry(columns=[("a", "text"), ("a", "bigint")])])


def test_part_with_another_header_fails(spark, raw, tmp_path):
    folder = tmp_path / RAW_TABLES["product_category_translation"].file
    raw["product_category_translation"].coalesce(1).write.option("header", True).csv(str(folder))
    (folder / "part-99999.csv").write_text("product_category_name,something_else\na,b\n")
    with pytest.raises(Exception, match="header"):
        scan(spark, str(tmp_path), RAW_TABLES["product_category_translation"]).collect()


def test_files_may_carry_a_publisher_prefix(spark, raw, tmp_path):
    named = with_file_prefix({"sellers": RAW_TABLES["sellers"]}, "acme_")
    raw["sellers"].write.option("header", True).csv(str(tmp_path / "acme_sellers_dataset.csv"))
    assert scan_all(spark, str(tmp_path), named)["sellers"].count() == 2


def test_missing_file_is_named(spark, incoming, tmp_path):
    only = {"orders": RAW_TABLES["orders"], "sellers": RAW_TABLES["sellers"]}
    assert missing_files(spark, str(incoming), only) == []
    with pytest.raises(FileNotFoundError, match="orders_dataset.csv"):
        scan_all(spark, str(tmp_path), only)


def test_snapshots_replay_and_replace(spark, raw, incoming, tmp_path):
    zone, target = str(tmp_path / "zone"), str(tmp_path / "raw")
    only = {"customers": RAW_TABLES["customers"], "order_reviews": RAW_TABLES["order_reviews"]}
    with pytest.raises(LookupError):
        landing.latest_prefix(spark, zone)
    first = landing.land(spark, str(incoming), zone, date(2024, 5, 1), NOW, only)
    later = tmp_path / "later"
    _offer(raw["customers"].limit(2), later, "customers")
    _offer(raw["order_reviews"].limit(1).drop("review_comment_message").withColumn("review_comment_message", F.lit("x"))
           .select(*raw["order_reviews"].columns), later, "order_reviews")
    second = landing.land(spark, str(later), zone, date(2024, 5, 2), NOW.replace(hour=13), only)
    assert landing.latest_prefix(spark, zone) == second

    for load_id, prefix, rows in (("a", second, 2), ("b", first, 8), ("c", first, 8)):
        loaded = landing.load(spark, prefix, target, load_id, NOW, only)
        assert loaded["customers"].count() == rows
        assert {r.load_id for r in loaded["customers"].select("load_id").distinct().collect()} == {load_id}
    assert sorted(r.load_id for r in landing.loads(spark, target).collect()) == ["a", "b", "c"]
    # Repeating a date replaces that snapshot for those who ask for the date.
    again = landing.land(spark, str(later), zone, date(2024, 5, 1), NOW.replace(hour=14), only)
    assert landing.prefix_on(spark, zone, date(2024, 5, 1)) == landing.latest_prefix(spark, zone) == again != first
    assert scan(spark, again, RAW_TABLES["customers"]).count() == 2
    assert scan(spark, first, RAW_TABLES["customers"]).count() == 8
    with pytest.raises(LookupError, match="2024-05-03"):
        landing.prefix_on(spark, zone, date(2024, 5, 3))


def test_a_refused_landing_of_a_date_keeps_the_one_before(spark, raw, tmp_path):
    only, zone = {"sellers": RAW_TABLES["sellers"]}, str(tmp_path / "zone")
    _offer(raw["sellers"], tmp_path / "in", "sellers")
    first = landing.land(spark, str(tmp_path / "in"), zone, date(2024, 5, 1), NOW, only)
    (tmp_path / "in" / RAW_TABLES["sellers"].file / "part-99999.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ContractError):
        landing.land(spark, str(tmp_path / "in"), zone, date(2024, 5, 1), NOW.replace(hour=15), only)
    assert landing.prefix_on(spark, zone, date(2024, 5, 1)) == landing.latest_prefix(spark, zone) == first
    assert scan(spark, first, RAW_TABLES["sellers"]).count() == raw["sellers"].count()


def test_readers_see_one_version_until_the_next_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(LookupError):
        versions.read(spark, path)
    first = write_table(spark.range(5), path)
    with pytest.raises(Exception, match="broken"):
        write_table(spark.range(9).where(F.raise_error(F.lit("broken")).isNull()), path)
    assert versions.read(spark, path).count() == 5
    write_table(spark.range(7), path)
    # Who opened the table before goes on reading what was there then.
    assert (first.count(), versions.read(spark, path).count(), versions.read(spark, path, back=1).count()) == (5, 7, 5)
    write_table(spark.range(8), path)
    assert len(versions.prune(spark, path, keep=2)) == 1
    assert (versions.read(spark, path).count(), versions.read(spark, path, back=1).count()) == (8, 7)
    assert len(list((tmp_path / "t").glob("v-*"))) == 3  # and the folder of the failed write, which no log names
    assert len(versions.prune(spark, path)) == 2


def _of_days(spark, rows):
    return spark.createDataFrame(rows, "k long, day date, v string")


def test_only_days_that_differ_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    rows = [(k, [*days, None][k % 4], None if k % 5 == 0 else f"v{k}") for k in range(40)]
    df = _of_days(spark, rows)
    assert len(refresh_days(df, path, "day", ["k"])) == 4
    assert refresh_days(df.repartition(7), path, "day", ["k"]) == []
    one = [(k, d, "new" if k == 9 else v) for k, d, v in rows]
    assert refresh_days(_of_days(spark, one), path, "day", ["k"]) == ["2024-01-02"]
    written = sorted(p.name for f in (tmp_path / "t").glob("v-*") for p in f.glob("day=*"))
    assert written.count("day=2024-01-02") == 2 and len(written) == 5
    # A day goes, one comes, and rows of no day change.
    other = [(k, date(2024, 1, 9) if d == days[0] else d, "x" if d is None else v) for k, d, v in one]
    assert refresh_days(_of_days(spark, other), path, "day", ["k"]) == [None, "2024-01-01", "2024-01-09"]
    stored = versions.read(spark, path, df.schema, "day")
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(other, key=str)
    assert sorted(map(tuple, versions.read(spark, path, df.schema, "day", back=1).collect()), key=str) == sorted(one, key=str)
    plan = stored.where(F.col("day") == days[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_digests_ignore_order_and_see_copies(spark):
    rows = [(1, date(2024, 1, 1), "a"), (2, date(2024, 1, 1), "b")]
    digest = lambda r: versions.day_digests(_of_days(spark, r), "day").collect()
    assert digest(rows) == digest(rows[::-1])
    assert len({str(digest(r)) for r in (rows, rows * 3, [*rows, rows[0], rows[0]], [(1, rows[0][1], "b"), (2, rows[0][1], "a")])}) == 4


def test_a_landed_extra_column_still_fails_the_load(spark, raw, tmp_path):
    only = {"sellers": RAW_TABLES["sellers"]}
    _offer(raw["sellers"].withColumn("loyalty_tier", F.lit(1)), tmp_path / "in", "sellers")
    prefix = landing.land(spark, str(tmp_path / "in"), str(tmp_path / "zone"), date(2024, 5, 1), NOW, only)
    assert "loyalty_tier" in header_of(spark, prefix, only["sellers"])
    with pytest.raises(ContractError, match="loyalty_tier"):
        landing.load(spark, prefix, str(tmp_path / "raw"), "a", NOW, only)


def test_partitioned_write_splits_a_hot_day(spark, tmp_path):
    hot = F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.col("id") % 20 + 1)
    df = spark.range(0, 90_000, 1, 8).select(
        F.date_add(F.lit("2020-01-01").cast("date"), hot.cast("int")).alias("day"), F.uuid().alias("cluster"), "id"
    )
    path = str(tmp_path / "t")
    # At this size a day is split only if a partition may hold very little.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    stored = write_partitioned(df, path, "day", ["cluster"])
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert stored.schema["day"].dataType.simpleString() == "date" and stored.count() == 90_000
    assert len(list((tmp_path / "t").glob("v-*/day=2020-01-01/*.parquet"))) > 1
    fifth = F.col("day") == date(2020, 1, 6)
    plan = stored.where(fifth)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    stored = replace_days(df.where(fifth).withColumn("cluster", F.lit("new")), path, "day", ["cluster"])
    assert stored.count() == 90_000
    assert [r.day for r in stored.where("cluster = 'new'").select("day").distinct().collect()] == [date(2020, 1, 6)]


def test_clustered_and_replaced_tables(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    stored = write_clustered(df, str(tmp_path / "c"), ["k", "id"])
    stored = write_clustered(df, str(tmp_path / "c"), ["k", "id"])
    assert stored.count() == 100
    assert write_table(df.limit(3), str(tmp_path / "c")).count() == 3


def test_targets_guard_and_client_limit(spark, tmp_path):
    lake = Lake(str(tmp_path), "ci")
    assert lake.path("marts", "fct_orders") == f"{tmp_path}/ci/marts/fct_orders"
    df = spark.range(5)
    assert not publish(df, lake.path("marts", "x"))
    assert not (tmp_path / "ci").exists()
    assert publish(df, lake.path("marts", "x"), allow_replace=True)
    assert len(to_client(df, 5)) == 5
    with pytest.raises(ValueError):
        to_client(df, 4)


def test_a_clean_snapshot_has_no_findings(spark, incoming):
    assert findings(spark, str(incoming)).collect() == []


def test_findings_list_every_bad_part_row_and_cell(spark, raw, tmp_path):
    only = {name: RAW_TABLES[name] for name in ("order_items", "orders", "order_reviews", "products")}
    _offer(raw["order_items"], tmp_path, "order_items")
    _offer(raw["orders"], tmp_path, "orders")
    raw["order_reviews"].write.options(header="true", escape='"').csv(str(tmp_path / only["order_reviews"].file))
    items, reviews = (tmp_path / only[t].file for t in ("order_items", "order_reviews"))
    head = ",".join(c for c, _ in only["order_items"].columns)
    stamp = "2024-01-01 00:00:00"
    (items / "part-90001.csv").write_text(
        f"{head}\nx,1,p,s,{stamp},fifty-eight,1.0\ny,one,p,s,soon,2.5,1.0\nz,1,p,s,{stamp},2.5,1.0\n,,,,,,\n"
    )
    (items / "part-90002.csv").write_text(f"{head}\nx,1,p,s,{stamp},2.5,1.0,EXTRA\ny,1,p\n")
    (items / "part-90003.csv").write_text(f"{head},loyalty_tier\nx,1,p,s,{stamp},2.5,1.0,gold\n")
    (items / "part-90004.csv").write_text(f"{head.replace('price,', '')}\nx,1,p,s,{stamp},1.0\n")
    (items / "part-90005.csv").write_text(",".join(reversed(head.split(","))) + f"\n1.0,2.5,{stamp},s,p,1,x\n")
    (items / "part-90006.csv").write_text('"' + head.replace(",", '","') + f'"\nq,1,p,s,{stamp},2.5,1.0\n')
    head = ",".join(c for c, _ in only["order_reviews"].columns)
    (reviews / "part-90007.csv").write_text(f'{head}\nr,o,five,"a\nb ""c"", d",,{stamp},{stamp}\n')
    found = findings(spark, str(tmp_path), only).collect()
    assert sorted(((r.table, r.file, r.problem, r.column, r.value) for r in found), key=str) == sorted([
        ("order_items", "part-90001.csv", "type", "price", "fifty-eight"),
        ("order_items", "part-90001.csv", "type", "order_item_id", "one"),
        ("order_items", "part-90001.csv", "type", "shipping_limit_date", "soon"),
        ("order_items", "part-90002.csv", "number of cells", None, None),
        ("order_items", "part-90002.csv", "number of cells", None, None),
        ("order_items", "part-90003.csv", "header: undeclared columns", "loyalty_tier", None),
        ("order_items", "part-90004.csv", "header: missing columns", "price", None),
        ("order_items", "part-90005.csv", "header: order of columns", None, None),
        ("order_reviews", "part-90007.csv", "type", "review_score", "five"),
        ("products", only["products"].file, "no file", None, None),
    ], key=str)
    # The load is refused as before.
    with pytest.raises(FileNotFoundError):
        landing.load(spark, str(tmp_path), str(tmp_path / "raw"), "a", NOW, only)
    for name in ("order_items", "order_reviews"):
        with pytest.raises(ContractError):
            landing.load(spark, str(tmp_path), str(tmp_path / "raw"), "a", NOW, {name: only[name]})


def test_findings_agree_with_the_strict_read(spark, tmp_path):
    """Whatever a strict read refuses has a finding, and nothing else has."""
    table = declare([{"table": "t", "file": "t.csv", "columns": {"a": "text", "n": "bigint", "x": "double", "at": "timestamp"}}])
    records = [
        "a,1,1.5,2024-01-01 00:00:00", "a,,,", ",,,", "a,1.0,1,2024-01-01", "a, 1,1,2024-01-01", "a,1,1e3,2024-01-01T10:00:00",
        "a,1,NaN,2024-01-01", "a,1,x,", "a,99999999999999999999,1,", "a,1,1,2024-13-01", '"a,b",1,1,', "a,1,1", "a,1,1,,", "a,1,1,,b",
    ]
    for k, record in enumerate(records):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "t.csv").write_text(f"a,n,x,at\n{record}\n")
        try:
            scan(spark, str(tmp_path / str(k)), table["t"]).collect()
            refused = False
        except Exception as error:
            assert "MALFORMED" in str(error)
            refused = True
        assert bool(findings(spark, str(tmp_path / str(k)), table).count()) == refused, record


def _bytes_for(folder, column, value):
    """(bytes of row groups that may hold the value, bytes of all)."""
    read = whole = 0
    for file in Path(folder).glob("v-*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            stats = group.column(at).statistics
            whole += group.total_byte_size
            read += group.total_byte_size * (stats.min <= value <= stats.max)
    return read, whole


def test_a_lookup_by_either_key_skips_most_row_groups(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.col("id").alias("row"), F.format_string("p%04d", F.xxhash64("id") % 1000 + 1000).alias("product"),
        # A third of the rows have one seller.
        F.when(F.col("id") % 3 == 0, "s0500").otherwise(F.format_string("s%04d", F.xxhash64(F.col("id") + 7) % 500 + 500)).alias("seller"),
    )
    by_one, by_both = str(tmp_path / "one"), str(tmp_path / "both")
    write_table(rows.repartitionByRange(64, "product").sortWithinPartitions("product"), by_one)
    stored = write_zordered(rows, by_both, ["product", "seller"], ["row"], bits=4, files=64)
    assert sorted(stored.collect()) == sorted(rows.collect())
    for column, value in (("product", "p1234"), ("product", "p0100"), ("seller", "s0700"), ("seller", "s0042")):
        read, whole = _bytes_for(by_both, column, value)
        assert 0 < read < whole / 3, (column, value)
    # In the order of one key alone, the other's lookups read everything.
    read, whole = _bytes_for(by_one, "seller", "s0700")
    assert read == whole


def test_ranges_hold_even_shares_and_a_hot_key_one(spark):
    rows = spark.createDataFrame([(k,) for k in [None] * 5 + [0] * 300 + list(range(1, 601))], "k long")
    ends = range_ends(rows, "k", 3)
    assert ends == sorted(ends) and len(ends) <= 7 and ends[0] == 1  # the hot key's range is its own
    assert range_ends(rows.where("false"), "k", 3) == [] and range_ends(rows.where("k is null"), "k", 3) == []


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for r in rows.select("a", "b", interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect():
        assert r.z == int("".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}", strict=True)), 2)


def test_zordered_nulls_repeats_and_empty(spark, tmp_path):
    rows = spark.createDataFrame([(None, "x", 1), ("a", None, 1), ("a", None, 1), (None, None, 2), ("", "", 3)], "a string, b string, _cell int")
    stored = write_zordered(rows, str(tmp_path / "t"), ["a", "b"])
    assert stored.columns == rows.columns and sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))
    assert write_zordered(rows.where("false"), str(tmp_path / "e"), ["a", "b"]).count() == 0


def test_zordered_makes_its_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("id", "id % 37 a", "id % 91 b").mapInArrow(seen, "id long, a long, b long")
    assert sorted(write_zordered(rows, str(tmp_path / "t"), ["a", "b"], ["id"], bits=3).collect()) == sorted(rows.collect())
    assert made.value == 2 * 1000  # once to write, once to compare


def test_range_of_counts_the_ends_reached(spark):
    rows = spark.createDataFrame([(k,) for k in [None, -1, 0, 1, 2, 3, 5, 8, 9]], "k long")
    ends = [0, 2, 3, 8]
    for r in rows.select("k", _range_of(F.col("k"), ends).alias("n"), _range_of(F.col("k"), []).alias("none")).collect():
        assert r.n == sum(r.k is not None and end <= r.k for end in ends) and r.none == 0
