"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as driver
from oracle import compare, connect

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert df.count() >= 0


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["event_id", "rule", "destination", "checkpoint", "outbound"]
    assert df.count() > 0
