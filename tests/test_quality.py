from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickwell.operators import quality as Q
from tickwell.schemas import RAW_PRICES, VOLUMES_TABLE
from tickwell.sources.days import write_days

SCHEMA = "symbol string, timestamp timestamp, price double"


def prices(spark, n, null_symbols=0, copies=0, bad=0):
    start = datetime(2024, 1, 1)
    rows = [[None if i < null_symbols else "A", start + timedelta(seconds=i), -1.0 if i < bad else 1.0] for i in range(n)]
    for i in range(copies):
        rows[n - 1 - i] = list(rows[0 if null_symbols == 0 else n // 2])
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA)


def checks(report):
    return {r.check_name: r for r in report.collect()}


@pytest.mark.parametrize("nulls, passed", [(4, True), (5, False)])
def test_five_percent_nulls_fail(spark, nulls, passed):
    row = checks(Q.price_report(prices(spark, 100, null_symbols=nulls), "2024-01-01"))["symbol_nulls"]
    assert row.passed is passed and row.percentage == pytest.approx(nulls)
    assert row.message == f"{nulls} null values ({nulls}.00%)"
    assert row.error == (None if passed else "Too many nulls in symbol")


@pytest.mark.parametrize("copies, passed", [(9, True), (10, False)])
def test_ten_percent_duplicates_fail(spark, copies, passed):
    row = checks(Q.price_report(prices(spark, 100, copies=copies), "2024-01-01"))["duplicates"]
    assert (row.value, row.passed) == (copies, passed)
    assert row.message == f"{copies} duplicate records ({copies}.00%)"


def test_null_keys_count_as_duplicates(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(None, t, 1.0), (None, t, 1.0), (None, None, 1.0), ("A", t, 1.0)], SCHEMA)
    assert df.dropDuplicates(["symbol", "timestamp"]).count() == 3
    assert checks(Q.price_report(df, "2024-01-01"))["duplicates"].value == 1


def test_no_rows_gives_one_failed_check(spark):
    report = Q.price_report(prices(spark, 5).limit(0), "2024-01-01")
    assert [(r.check_name, r.value, r.passed, r.error) for r in report.collect()] == [
        ("record_count", 0, False, "No records found")]
    verdict = Q.verdict(report).first()
    assert verdict.passed is False and verdict.errors == ["No records found"]


def test_verdict_lists_every_error(spark):
    verdict = Q.verdict(Q.price_report(prices(spark, 100, null_symbols=5, bad=1), "2024-01-01")).first()
    assert verdict.errors == ["Found non-positive prices", "Too many nulls in symbol"]
    good = Q.verdict(Q.price_report(prices(spark, 100), "2024-01-01"))
    assert good.first().passed is True and good.first().errors == []
    both = good.unionAll(Q.verdict(Q.price_report(prices(spark, 100, bad=1), "2024-01-01")))
    assert Q.overall_verdict(both).first().passed is False


def test_stored_day(spark, folder):
    given = {"symbol": F.lit("A"), "timestamp": F.col("id").cast("string"), "price": F.lit(1.0),
             "year": F.lit(2024), "month": F.lit(1), "day": F.lit(5)}
    rows = spark.range(10).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                                    for f in RAW_PRICES.fields])
    root = f"{folder}/raw"
    write_days(rows, root)
    report = Q.day_report(spark, root, RAW_PRICES, "prices", "2024-01-05")
    assert Q.verdict(report).first().passed is True
    missing = Q.day_report(spark, root, RAW_PRICES, "prices", "2024-01-06").collect()
    assert [r.error for r in missing] == ["No records found"]


def test_unreadable_day_fails(spark, folder):
    import pathlib
    day = pathlib.Path(folder, "raw", "year=2024", "month=1", "day=5")
    day.mkdir(parents=True)
    (day / "part-0.parquet").write_bytes(b"this is no parquet file")
    rows = Q.day_report(spark, f"{folder}/raw", RAW_PRICES, "prices", "2024-01-05").collect()
    assert [(r.check_name, r.passed) for r in rows] == [("readable", False)] and rows[0].error


def test_schema_report(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("A", t, t.date(), 1, "x"), (None, t, t.date(), 1, "x")],
                               "symbol string, timestamp timestamp, date date, volume int, extra string")
    got = {r.column_name: (r.expected_type, r.found_type, r.missing_values, r.passed)
           for r in Q.schema_report(df, VOLUMES_TABLE).collect()}
    assert got["symbol"] == ("string", "string", 1, False)
    assert got["timestamp"] == ("timestamp", "timestamp", 0, True)
    assert got["volume"] == ("bigint", "int", 0, False)
    assert got["price"] == ("double", None, 0, False)
    assert got["extra"] == (None, "string", 0, False)
