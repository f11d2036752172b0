"""Every registered query against its SQL twin, and the plans of all lazy ones."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in getattr(entry.llm, "QUERIES", {}) and n != "pipeline"])
def test_query_equals_sql(spark, con, name):
    text, _, ok = compare(spark, con, SF_DIR, name)
    assert ok, text


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


OWN = [name for name in entry.queries() if name not in getattr(entry.llm, "QUERIES", {}) and name != "pipeline"]


@pytest.mark.parametrize("name", OWN)
def test_plan_has_no_cross_join_and_no_python(spark, capsys, name):
    entry.queries()[name](spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|MapInPandas", plan)


@pytest.mark.parametrize("name", ["latest_prices", "daily_today", "market_summary", "volatility_30d"])
def test_date_filters_reach_every_scan(spark, capsys, name):
    entry.queries()[name](spark, SF_DIR).explain("formatted")
    plan = capsys.readouterr().out
    scans = [part for part in plan.split("\n\n") if re.search(r"Scan parquet\s*\n", part) and "events.parquet" in part]
    assert scans and all(re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", part) for part in scans)
    assert "ExistingRDD" not in plan


@pytest.mark.parametrize("name", ["tt_compare_snapshots", "tt_current_vs_historical"])
def test_stored_versions_are_compared_without_a_shuffle(spark, capsys, name):
    entry.queries()[name](spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_filters_reach_the_files(spark, capsys):
    entry.queries()["daily_summary_7d"](spark, SF_DIR).explain("formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", capsys.readouterr().out)
    entry.queries()["pruned_symbol_7d"](spark, SF_DIR).explain("formatted")
    assert re.search(r"PartitionFilters: \[.*symbol.* = purchase.*", capsys.readouterr().out)
