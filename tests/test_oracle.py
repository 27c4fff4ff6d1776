"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_points
import catalog.oracle
import catalog.queries

from compare import check, connect

# Python workers, nested loops and rows that come from the driver.
FORBIDDEN = [
    "BatchEvalPython",
    "ArrowEvalPython",
    "InPandas",
    "InArrow",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "Scan ExistingRDD",
]

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries.QUERIES
ORACLE = catalog.oracle.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLE.keys() <= entry_points.oracle_sql().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert check(df, con, ORACLE[name]) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "n"
    assert df.count() == 10
