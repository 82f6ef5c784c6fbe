"""Every registered query against its SQL oracle, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The queries of the optional subpackage have their own tests.
QUERIES, ORACLES = entry.QUERIES, entry.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_and_types_as_the_oracle(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    assert oracle.type_differences(db, df, ORACLES[name]) == {}
    assert oracle.from_spark(df) == oracle.from_duckdb(db, ORACLES[name])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_flagship_has_one_row_per_municipality(spark):
    assert entry.entry(spark).count() == 25
