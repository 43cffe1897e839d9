"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import os

import pytest
from check_oracle import compare, connect
from conftest import TESTDATA

import __spark_entry__ as entry_module
from panelloom.plans import driver_queries

SF_DIR = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables at hand")
NAMES = sorted(driver_queries.QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    assert len(set(df.columns)) == len(df.columns)
    assert compare(df, con, entry_module.oracle_sql()[name]) is None


def test_entry_returns_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "survey_year" and df.count() > 0


def test_plans_read_only_what_they_need_and_have_no_python_or_cross_product(spark):
    """No Python in a plan; a nested-loop join only ever meets a one-row aggregate."""
    for name in ("gold_market_overview", "gold_compensation_by_role", "option_adoption", "gold_skill_priority_score"):
        plan = entry_module.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan
    plan = entry_module.queries()["gold_compensation_by_seniority"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
