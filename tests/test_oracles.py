"""Every registered query against its SQL and for what its plan may not hold; TEST_SF picks the table size."""

import os

import pytest
from conftest import plan_of
from oracle import compare, duck

import __spark_entry__ as registered
from stratalake.plans.registry import ORACLES, QUERIES

FOLDER = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
        assert operator not in plan
    assert compare(df, con, ORACLES[name]) is None


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["s_suppkey", "n_visits", "mean_wait", "n_cancelled", "n_people", "s_name", "n_name"]
    assert result.count() > 0
    assert result.where("n_cancelled > 0").count() == 0  # silver dropped the cancelled orders
