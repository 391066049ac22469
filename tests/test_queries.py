"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows_of

# Products of tables, and rows sent to Python one way or another.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF")

FOLDER = Path("/root/testdata/sf0.001")
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3


def plan_of(spark, name):
    return QUERIES[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    day = plan_of(spark, "visitors_on_one_day")
    assert "GreaterThanOrEqual(o_orderdate" in day and "LessThan(o_orderdate" in day
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in day
    assert "ReadSchema: struct<l_partkey:bigint>" in plan_of(spark, "hll_estimate_whole_table")
    assert plan_of(spark, "exact_vs_estimate_by_kind").count("FileScan") == 1
    assert plan_of(spark, "precision_sweep_parts").count("FileScan") == 1


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, str(FOLDER))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    found = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    assert found or name in ("slice_of_orders",)
    if name in SQL:
        cursor = tables.execute(SQL[name])
        columns = [item[0] for item in cursor.description]
        assert sorted(columns) == sorted(frame.columns)
        assert found == rows_of(columns, cursor.fetchall())


def test_graph_plans_read_stored_tables(spark):
    """Sets of nodes are scratch tables, a scan per hop; a hub's name comes with its size."""
    assert plan_of(spark, "services_in_network").count("FileScan") <= 12
    assert plan_of(spark, "co_members_of_hubs").count("FileScan") <= 14
