"""Every registered query against its independent SQL."""

import pytest
from oracle_compare import TESTDATA, compare, connect

import __spark_entry__

# The optional corpus queries have tests of their own.
QUERIES, SQL = ({k: f[k] for k in f if k in __spark_entry__._QUERIES} for f in (__spark_entry__.queries(), __spark_entry__.oracle_sql()))
SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_matches_sql(spark, con, key):
    _, problems = compare(spark, con, QUERIES[key], SQL[key], SF_DIR)
    assert not problems


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
