"""Every registered query against its SQL, all values."""

import os

import pytest
from conftest import SMALL_SF
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_SF), reason="driver tables not present")


# All-pairs joins and row-at-a-time Python have no place in any plan.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL_SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    df = queries()[name](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in UNWANTED if bad in plan]
    assert compare(con, df, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only(spark, name):
    assert queries()[name](spark, SMALL_SF).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
