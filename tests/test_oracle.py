"""Every query with SQL equals DuckDB on the smallest test data."""

import pytest
from compare import connect, difference

from ledgerflow.plans.registry import load

QUERIES = load()


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_equals_sql(name, spark, small, db):
    query = QUERIES[name]
    df = query.run(spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    problem = difference(df, db, query.sql)
    assert problem is None or problem.startswith("EMPTY"), problem


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_runs_without_sql(name, spark, small):
    assert QUERIES[name].run(spark, small).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_deduplication_limits_groups_before_the_shuffle(spark, small):
    plan = QUERIES["c06_keep_first"].run(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_unused_columns_are_pruned_through_cleaning(spark, small):
    plan = QUERIES["v10_won_deal_followups"].run(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan
