"""Every registered query against its SQL in DuckDB, on the whole smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    problems, count = compare(df, con, ORACLE.get(name))
    assert problems == []
    assert count >= 0
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)
