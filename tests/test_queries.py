"""Every registered query against its SQL on the smallest data set."""

import pytest
from conftest import SMALL, plan_of
from oracle import compare, connect

import __spark_entry__ as entry_points
from cartwheel.inventory import QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = entry_points.queries()[name](spark, SMALL)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, db, sql) == []
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
