"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


def test_contract(spark):
    known, sql = contract.queries(), contract.oracle_sql()
    assert len(known) > 80 and set(sql) <= set(known)
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, db, name):
    sql = contract.oracle_sql().get(name)
    df = contract.queries()[name](spark, SF_DIR)
    if sql is None:
        df.collect()
        return
    assert oracle.compare(df, db, sql) is None
