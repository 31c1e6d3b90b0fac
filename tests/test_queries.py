"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.oracle import oracle
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle()


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(spark, duck, SF_DIR, name, SQL[name]) == ""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["snapshot_date", "total", "defaults", "default_rate"]
    assert df.count() == 83
