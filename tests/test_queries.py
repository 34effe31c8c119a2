"""Every query with SQL against DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from jobs import queries as jobs
from tremor.plans import queries as seismic

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = seismic.QUERIES | jobs.QUERIES, seismic.SQL | jobs.SQL
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    rows = duck.sql("select " + ", ".join(f'"{c}"' for c in columns) + f" from ({SQL[name]})").fetchall()
    assert sorted(repr([plain(v) for v in r]) for r in got.select(*columns).collect()) == sorted(repr([plain(v) for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert entry.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 53


@pytest.mark.parametrize("name", ["hjorth", "hjorth_standard", "hop_windows", "moments", "window_labels"])
def test_windows_are_matrices(spark, name):
    """Samples are sent as arrays and numbered within quarters: none is dealt to each window that holds it and sorted there."""
    plan = entry.queries()[name](spark, DATA)._jdf.queryExecution().toString()
    logical = plan.split("== Optimized Logical Plan ==")[0]
    assert "sequence(" not in logical and ("MapInArrow" in plan or name == "window_labels")


def test_overlapping_samples_are_hashed(spark):
    plan = entry.queries()["overlap_last_wins"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
