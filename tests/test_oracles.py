"""Every catalogue query against its SQL oracle on whole tables."""

import pytest
from compare import connect, differences

from commerce_lake.catalog import all_oracles, all_queries

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_catalogue_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
