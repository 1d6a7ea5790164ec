from __future__ import annotations

import pytest

from tests.conftest import DATA
from userlake.llm.oracle import statements
from userlake.llm.queries import registered
from verification.compare import connect, difference

QUERIES = registered()
NATIVE = {"op2_chat_format", "op4_quality_rules", "op5_sanitise"}


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_equals_its_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, DATA), duck, statements()[name]) == ""


@pytest.mark.parametrize("name", sorted(NATIVE & set(QUERIES)))
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
