"""Every registered query against its SQL twin."""

import pytest
from compare import database, spark_rows, sql_rows

import __spark_entry__ as driver
from tidemark.oracles import ORACLES
from tidemark.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    want_names, want = sql_rows(con, ORACLES[name])
    assert names == want_names
    assert rows == want
    assert rows or name == "revenue_trailing"


def test_entry(spark):
    assert driver.entry(spark).count() == 117
