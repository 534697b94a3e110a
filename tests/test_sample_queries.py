"""Every query over the sample tables against its SQL, and the shape of the heavy plans."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from closewright.checks.queries import QUERIES, classified, runner
from closewright.sources.sample_views import BASE_TABLES, SampleTables

FOLDER = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return str(v) if isinstance(v, pd.Timestamp) else v


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)]
    data = [tuple(cell(v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    return list(pdf.columns), sorted(data, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = canonical(runner(name)(spark, FOLDER).toPandas())
    text = entry_point.oracle_sql().get(name)
    if text is None:
        assert got[1]
        return
    assert got == canonical(duck.execute(text).df())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["category", "voucher_type", "amount_local", "row_count"]
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_invariants(spark):
    t = SampleTables(spark, FOLDER)
    ledger = classified(t)
    assert ledger.count() == t["gl_entries"].count()
    pivot = runner("nav_pivot_total")(spark, FOLDER).toPandas()
    total = pivot[pivot.category == "__TOTAL__"]
    assert total.row_count.iloc[0] == pivot[pivot.category != "__TOTAL__"].row_count.sum()


@pytest.mark.parametrize("name", ["gl_classified", "variance_status", "collection_open_items", "voucher_usage_monthly", "merge_key_overlap", "business_line_reclass"])
def test_plans_have_no_python_or_cartesian(spark, name):
    plan = runner(name)(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_filters_reach_the_scan(spark):
    plan = runner("scope_rolling_year")(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_orderpriority" not in plan.split("FileScan")[1].split("Batched")[0]
