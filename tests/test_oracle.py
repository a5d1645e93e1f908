"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: the queries on training data have tests of their own
QUERIES, ORACLES = entry.QUERIES, entry.ORACLES


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "EvalPython" not in plan and "InArrow" not in plan
    columns, rows = compare.spark_rows(result)
    expected_columns, expected = compare.duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows, "an empty result proves nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).collect()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_ranks_one_city(spark):
    rows = entry.entry(spark).collect()
    assert rows and {row["city"] for row in rows} == {"london"}
    assert sorted(row["rank"] for row in rows) == list(range(1, len(rows) + 1))
