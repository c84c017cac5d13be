"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry_points
from stratum import queries as registry
from oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = registry.QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin") if bad in plan]
    sql = registry.ORACLES.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
