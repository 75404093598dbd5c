"""Every query with SQL against DuckDB; the others run and keep their schema."""

import pytest
from oracle import connect, same

from quillmark.plans import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    same(spark, duck, QUERIES[name], SQL[name], DATA)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert df.count() >= 0 and df.columns
