"""Every registered query against its SQL in DuckDB, on the same tables."""

import os

import pytest

import __spark_entry__ as driver
from tidemark.plans import oracles, reports
from tests.oracle import connect, duck_rows, spark_rows

QUERIES, ORACLES = reports.QUERIES, oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(testdata):
    return connect(testdata)


@pytest.fixture(scope="module")
def testdata():
    return "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


# Streams and refreshes have tests of their own; set ALL_REPORTS to run them here as well.
BATCH = [n for n in QUERIES if os.environ.get("ALL_REPORTS") or not n.startswith(("stream_", "refresh_"))]


@pytest.mark.parametrize("name", BATCH)
def test_query_equals_its_sql(spark, duck, testdata, name):
    assert spark_rows(QUERIES[name](spark, testdata)) == duck_rows(duck, ORACLES[name])


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "sale_date", "store_id", "store_name",
        "total_revenue", "total_transactions", "total_items_sold", "unique_customers",
    ]
