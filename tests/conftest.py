"""One Spark session and a small, dirty marketplace with known answers."""

from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from commerce_lake.params import Params  # noqa: E402
from commerce_lake.plans.models import Models  # noqa: E402
from commerce_lake.session import tune  # noqa: E402
from commerce_lake.sources.schema import RAW_TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return tune(session)


def at(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


# Customer A orders three times and moves; B and C once each; D's two orders
# share a time stamp; E never receives anything.
CUSTOMERS = [
    ("c1", "A", "01234", " Rio ", "rj"),
    ("c2", "A", "01234", "RIO", "RJ "),
    ("c3", "A", "99999", "Santos", "sp"),
    ("c4 ", " B", "01234", "rio", "RJ"),
    ("c5", "C", "55555", "Natal", "rn"),
    ("c6", "D", "01234", "rio", "rj"),
    ("c7", "D", "77777", "natal", "rn"),
    ("c8", "E", "88888", "belem", "pa"),
]


def _order(n, customer, status, bought, approved, carrier, delivered, due):
    return (f"o{n}", customer, status, at(bought), at(approved), at(carrier), at(delivered), at(due))


ORDERS = [
    # On time; then five days late; then exactly on the promised second.
    _order(1, "c1", "delivered", "2017-01-01 10:00:00", "2017-01-01 11:30:00", "2017-01-02 11:30:00", "2017-01-05 10:59:00", "2017-01-10 00:00:00"),
    _order(2, "c2", " Delivered", "2017-01-21 10:00:00", "2017-01-21 11:00:00", "2017-01-22 00:00:00", "2017-02-06 01:00:00", "2017-02-01 00:00:00"),
    _order(3, "c3", "shipped", "2017-06-01 00:00:00", "2017-06-01 01:00:00", "2017-06-02 00:00:00", "2017-06-10 00:00:00", "2017-06-10 00:00:00"),
    # Approved before it was bought.
    _order(4, "c4", "delivered", "2017-03-01 12:00:00", "2017-03-01 09:00:00", "2017-03-02 12:00:00", "2017-03-04 12:00:00", "2017-03-20 00:00:00"),
    _order(5, "c5", "canceled", "2018-07-15 08:00:00", None, None, None, "2018-08-01 00:00:00"),
    _order(6, "c6", "delivered", "2018-01-01 00:00:00", "2018-01-01 00:00:00", "2018-01-03 00:00:00", "2018-01-30 00:00:00", "2018-01-10 00:00:00"),
    _order(7, "c7", "invoiced", "2018-01-01 00:00:00", "2018-01-01 00:30:00", None, None, "2018-01-12 00:00:00"),
    _order(8, "c8", "processing", "2018-02-01 00:00:00", None, None, None, "2018-02-20 00:00:00"),
]

ITEMS = [
    ("o1", 1, "p1", "s1", at("2017-01-05 00:00:00"), 100.0, 10.0),
    ("o2", 1, "p1", "s1", at("2017-01-25 00:00:00"), 50.0, 5.0),
    ("o2", 2, "p2", "s2", at("2017-01-25 00:00:00"), 70.0, 7.0),
    ("o3", 1, "p3", "s1", at("2017-06-05 00:00:00"), 30.0, 3.0),
    ("o4", 1, "p1", "s2", at("2017-03-05 00:00:00"), 20.0, 2.0),
    ("o4", 2, "p2", "s2", at("2017-03-05 00:00:00"), 20.0, 2.0),
    ("o4", 3, "p4", "s2", at("2017-03-05 00:00:00"), 10.0, 1.0),
    ("o6", 1, "p2", "s1", at("2018-01-05 00:00:00"), 200.0, 0.0),
    ("o7", 1, "p3", "s1", at("2018-01-05 00:00:00"), 40.0, 4.0),
    ("o8", 1, "p1", "s1", at("2018-02-05 00:00:00"), 60.0, 6.0),
]

PAYMENTS = [
    ("o1", 1, "credit_card", 1, 100.0),
    ("o1", 2, " Voucher", 1, 10.0),
    ("o2", 1, "boleto", 1, 131.99),
    ("o3", 1, "credit_card", 30, 33.02),
    ("o4", 1, "credit_card", 3, 55.0),
    ("o6", 1, "debit_card", 1, 200.0),
    ("o7", 1, "credit_card", 2, 44.0),
    ("o8", 1, "credit_card", 2, 66.0),
]

REVIEWS = [
    # The same review three times: the latest answer wins, then the lower order.
    ("r1", "o1", 5, "  ", "great\n\"really\", great", at("2017-01-06 00:00:00"), at("2017-01-07 12:30:00")),
    ("r1", "o2", 4, None, None, at("2017-01-06 00:00:00"), at("2017-01-06 00:00:00")),
    ("r1", "o4", 1, None, None, at("2017-01-06 00:00:00"), at("2017-01-07 12:30:00")),
    ("r2", "o2", 2, "late", "", at("2017-02-07 00:00:00"), at("2017-02-08 00:00:00")),
    ("r3", "o2", 1, None, None, at("2017-02-07 00:00:00"), None),
    ("r3", "o6", 1, None, "slow", at("2018-02-01 00:00:00"), at("2018-02-03 00:00:00")),
    ("r4", "o4", 5, None, None, at("2017-03-05 00:00:00"), None),
]

PRODUCTS = [
    ("p1", "Beleza", 10, 20, 1, 100, 1, 2, 3),
    ("p2", "moveis", 11, 21, 2, 200, 1, 2, 3),
    ("p3", " ", None, None, None, None, None, None, None),
    ("p4", "pc_gamer", 12, 22, 3, 300, 1, 2, 3),
]
TRANSLATION = [("beleza", "health_beauty"), ("moveis", "Furniture ")]
SELLERS = [("s1", "01234", "Rio", "rj"), ("s2", "00000", " Nowhere", "ac")]

GEOLOCATION = [
    ("01234", -22.0, -43.0, "rio", "RJ"),
    ("01234", -24.0, -44.0, "rio", "RJ"),
    ("01234", -23.0, -46.0, "rio", "RJ"),
    ("55555", -5.0, -35.0, "natal", "RN"),
    ("55555", -6.0, -36.0, "natal", "RN"),
    ("55555", 50.0, -35.0, "natal", "RN"),
    ("77777", 60.0, 10.0, "elsewhere", "XX"),
]

ROWS = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ITEMS,
    "order_payments": PAYMENTS,
    "order_reviews": REVIEWS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
    "product_category_translation": TRANSLATION,
}


@pytest.fixture(scope="session")
def raw(spark):
    return {name: spark.createDataFrame(rows, RAW_TABLES[name].schema) for name, rows in ROWS.items()}


@pytest.fixture(scope="session")
def params():
    return Params(order_count_band=(1, 100), category_min_customers=1, state_min_customers=1)


@pytest.fixture(scope="session")
def models(raw, params):
    return Models(raw, params)


@pytest.fixture
def incoming(raw, tmp_path):
    """The nine tables as CSV files."""
    folder = tmp_path / "incoming"
    for name, df in raw.items():
        (
            df.coalesce(1).write.options(header="true", escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss")
            .csv(str(folder / RAW_TABLES[name].file))
        )
    return folder


def rows_by(df, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
