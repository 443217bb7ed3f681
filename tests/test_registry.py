"""Every registered query equals its SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(registry.queries()) - set(registry.LLM) == set(registry.oracle_sql()) - set(registry.LLM)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in registry.oracle_sql()])
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, name, FOLDER).startswith("ok")


def test_plans_hold_no_cross_joins_or_python(spark):
    for name in ("fact_point_in_time", "top_employees", "project_bottlenecks", "kpi_card",
                 "scd2_apply", "assign_employees", "make_reviews"):
        plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
        for banned in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert banned not in plan, (name, banned)


def test_scans_read_only_what_is_needed(spark):
    plan = registry.queries()["yoy_stored"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    fact = [line for line in plan.splitlines() if "FileScan" in line and "review_score" in line]
    assert fact and "job_satisfaction" not in fact[0]


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
