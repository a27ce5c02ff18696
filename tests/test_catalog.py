"""Every registered query against its SQL on the smallest given tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference

FOLDER = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_entry_gives_rows(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "snapshot_date" in df.columns


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
