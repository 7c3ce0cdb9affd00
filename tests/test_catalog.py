"""Queries against their SQL on the smallest tables, and the rules every query keeps."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from saleshouse import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# One or more of each module; tools/check.py compares them all.
CHOSEN = [
    "clv", "rfm", "affinity", "customer_segments", "cohort_pivot", "pareto", "stg_orders", "dq_scorecard", "dim_customer",
    "scd2_build", "scd2_apply", "fact_sales", "fact_sales_as_of", "fact_merge", "rep_kpis", "mv_refresh_daily",
    "opt_compare", "src_load_history", "qlog_by_user",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    return repr(round(value, 6)) if isinstance(value, float) else repr(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    result = db.execute(SQL[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in result.description], result.fetchall())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_warehouse_is_built_once(spark):
    assert catalog.warehouse(spark, FOLDER) is catalog.warehouse(spark, FOLDER)


@pytest.mark.parametrize("name", ["clv", "rep_category", "affinity", "val_sample", "fact_unknown_member", "scd2_apply", "cohort_pivot"])
def test_no_cross_joins(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "CartesianProduct" not in plan
