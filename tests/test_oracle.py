"""Every registered query against its SQL, on two scales."""

import pytest

import __spark_entry__ as entry_points
from compare import computed, oracle
from conftest import MEDIUM, SMALL

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()
# Joins of all pairs, and Python functions called row by row.
AVOIDED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM], ids=["small", "medium"])
def test_matches_sql(spark, name, sf_dir):
    expected_schema, expected = oracle(sf_dir, SQL[name])
    df = QUERIES[name](spark, sf_dir)
    schema, rows = computed(df)
    assert schema == expected_schema
    assert len(rows) == len(expected)
    assert rows == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in AVOIDED:
        assert node not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["example_id", "text"]
    assert rows.count() == 48
