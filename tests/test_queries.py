from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from tests.conftest import DATA
from verification.compare import connect, difference
from verification.oracle import SQL
from verification.queries import registered

QUERIES = registered()


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.fixture(scope="module")
def statements():
    return entry_points.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, statements, name):
    df = QUERIES[name](spark, DATA)
    assert difference(df, duck, statements[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)
