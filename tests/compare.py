"""Runs catalogue queries and their SQL oracles side by side.

    python tests/compare.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows under the same column names."""
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = _rows(expected_columns, cursor.fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(set(df.columns) ^ set(expected_columns))}"
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"rows {sum(found.values())} vs {sum(expected.values())}, {sum(extra.values())} differ:\n"
        f"   cols   {sorted(df.columns)}\n"
        f"   spark  {sorted(extra, key=repr)[:2]}\n   oracle {sorted(missing, key=repr)[:2]}"
    )


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = differences(df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} not matching")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
