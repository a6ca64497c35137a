"""Every registered query against its SQL on the smallest data."""

import os

import pytest
from checking import compare, connect

import __spark_entry__ as registered
from railgrain.plans.catalog import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(registered.queries()) and set(SQL) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = registered.queries()[name](spark, SF_DIR)
    assert compare(df, con, registered.oracle_sql()[name]) is None
