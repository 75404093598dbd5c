import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import connect, same  # noqa: E402

from quillmark.llm.queries import QUERIES, SQL  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    same(spark, connect(DATA), QUERIES[name], SQL[name], DATA)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_with_distinct_rows(spark, name):
    df = QUERIES[name](spark, DATA).cache()
    if name.endswith("_found"):
        assert df.count() == df.distinct().count()
    df.count()
    df.unpersist()
