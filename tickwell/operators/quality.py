"""Data quality reports: all checks of a dataset in one aggregation.

A report is a frame with one row per check: ``data_type, date, check_name, value,
percentage, passed, message, error``. ``error`` is set where a check failed.
"""

from __future__ import annotations

from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwell.schemas import REJECTS
from tickwell.sources.days import as_day, read_days

# Shares in percent that are already too high.
NULL_LIMIT_PCT = 5.0
DUPLICATE_LIMIT_PCT = 10.0

REPORT = ("data_type string, date date, check_name string, value bigint, percentage double, "
          "passed boolean, message string, error string")


def _check(name: str, value: Column, passed: Column, message: Column, error: str,
           percentage: Column | None = None) -> Column:
    share = F.lit(None).cast("double") if percentage is None else percentage
    return F.struct(
        F.lit(name).alias("check_name"),
        value.cast("bigint").alias("value"),
        share.alias("percentage"),
        passed.alias("passed"),
        message.alias("message"),
        F.when(~passed, F.lit(error)).alias("error"))


def _share(counter: Column) -> Column:
    return F.try_divide(counter, F.col("n")) * 100


def _percent_text(pattern: str, counter: Column, pct: Column) -> Column:
    return F.format_string(pattern, counter, F.bround(pct, 2))  # ties to even, as in the messages to match


def _null_check(column: str) -> Column:
    counter = F.col(f"null_{column}")
    pct = _share(counter)
    return _check(f"{column}_nulls", counter, pct < NULL_LIMIT_PCT,
                  _percent_text("%d null values (%.2f%%)", counter, pct),
                  f"Too many nulls in {column}", pct)


def _count_check(name: str, counter: Column, what: str, error: str) -> Column:
    return _check(name, counter, counter == 0, F.concat(counter.cast("string"), F.lit(f" {what}")), error)


def _report(df: DataFrame, data_type: str, day: str | date | None, counters: list[Column],
            checks: list[Column]) -> DataFrame:
    """One row per check; per date of ``df.date`` unless a day is given.

    A given day without rows yields only the failed record count.
    """
    n = F.col("n")
    first = _check("record_count", n, n > 0, F.format_string("Found %d records", n),
                   "No records found")
    if day is None:
        counted = df.groupBy("date").agg(F.count("*").alias("n"), *counters)
    else:
        counted = (df.agg(F.count("*").alias("n"), *counters)
                   .withColumn("date", F.lit(day).cast("date")))
    rows = F.when(n > 0, F.array(first, *checks)).otherwise(F.array(first))
    return (counted.select("date", F.explode(rows).alias("check"))
            .select(F.lit(data_type).alias("data_type"), "date", "check.*"))


def price_report(df: DataFrame, day: str | date | None = None) -> DataFrame:
    """Record count, NULL shares, non-positive prices and duplicates of price ticks.

    Duplicates count pairs (symbol, timestamp) as ``dropDuplicates`` does, rows with
    a NULL key included, which is why the pair is counted as a struct.
    """
    distinct = F.count_distinct(F.struct("symbol", "timestamp"))
    counters = [
        F.count_if(F.col("symbol").isNull()).alias("null_symbol"),
        F.count_if(F.col("price").isNull()).alias("null_price"),
        F.count_if(F.col("timestamp").isNull()).alias("null_timestamp"),
        F.count_if(F.col("price") <= 0).alias("bad_prices"),
        (F.count("*") - distinct).alias("duplicates"),
    ]
    duplicates = F.col("duplicates")
    duplicate_pct = _share(duplicates)
    checks = [
        _null_check("symbol"), _null_check("price"), _null_check("timestamp"),
        _count_check("positive_prices", F.col("bad_prices"), "non-positive prices",
                     "Found non-positive prices"),
        _check("duplicates", duplicates, duplicate_pct < DUPLICATE_LIMIT_PCT,
               _percent_text("%d duplicate records (%.2f%%)", duplicates, duplicate_pct),
               "Too many duplicate records", duplicate_pct),
    ]
    return _report(df, "prices", day, counters, checks)


def volume_report(df: DataFrame, day: str | date | None = None) -> DataFrame:
    counters = [
        F.count_if(F.col("symbol").isNull()).alias("null_symbol"),
        F.count_if(F.col("volume").isNull()).alias("null_volume"),
        F.count_if(F.col("volume") < 0).alias("negative_volumes"),
    ]
    checks = [
        _null_check("symbol"), _null_check("volume"),
        _count_check("non_negative_volumes", F.col("negative_volumes"), "negative volumes",
                     "Found negative volumes"),
    ]
    return _report(df, "volumes", day, counters, checks)


def verdict(report: DataFrame) -> DataFrame:
    """Per dataset and date: passed, and the list of errors (at most one per check)."""
    return report.groupBy("data_type", "date").agg(
        F.bool_and("passed").alias("passed"),
        F.array_sort(F.collect_list("error")).alias("errors"))


def overall_verdict(verdicts: DataFrame) -> DataFrame:
    """Per date: passed only if prices and volumes both did."""
    return verdicts.groupBy("date").agg(F.bool_and("passed").alias("passed"))


def schema_report(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per expected or found column: its types, and for a required column how
    many rows lack it. All columns are counted in one pass."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f for f in expected.fields}
    counters, rows = [F.lit(0).cast("bigint").alias("_none")], []
    for name in [*wanted, *(c for c in found if c not in wanted)]:
        kind = wanted[name].dataType.simpleString() if name in wanted else None
        missing = "_none"
        if name in found and name in wanted and not wanted[name].nullable:
            missing = f"_missing_{name}"
            counters.append(F.count_if(F.col(name).isNull()).alias(missing))
        rows.append(F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).cast("string").alias("expected_type"),
            F.lit(found.get(name)).cast("string").alias("found_type"),
            F.col(missing).alias("missing_values"),
            (F.lit(kind is not None and kind == found.get(name)) & (F.col(missing) == 0)).alias("passed")))
    return df.agg(F.count("*").alias("_n"), *counters).select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def reject_report(stored: DataFrame, rejects: DataFrame, data_type: str, day: date) -> DataFrame:
    """How many messages of a day became no tick, as a share of all its messages."""
    tagged = stored.select(F.lit(False).alias("lost")).unionAll(rejects.select(F.lit(True).alias("lost")))
    counts = tagged.agg(F.count_if(~F.col("lost")).alias("stored"), F.count_if("lost").alias("rejects"))
    counter = F.col("rejects")
    share = F.coalesce(F.try_divide(counter, F.col("stored") + counter) * 100, F.lit(0.0))
    row = _check("rejected_messages", counter, share < NULL_LIMIT_PCT,
                 _percent_text("%d rejected messages (%.2f%%)", counter, share), "Too many rejected messages", share)
    return counts.select(row.alias("check")).select(
        F.lit(data_type).alias("data_type"), F.lit(day).alias("date"), "check.*")


def day_report(spark: SparkSession, root: str, schema: StructType, data_type: str,
               day: str | date | None = None, rejects: str | None = None) -> DataFrame:
    """Checks one stored day, and with the ``rejects`` dataset what did not get stored. Data
    that cannot be read is a failed report."""
    wanted = as_day(day, spark)
    check = price_report if data_type == "prices" else volume_report
    try:
        stored = read_days(spark, root, schema, wanted)
        report = check(stored, wanted)
        if rejects is not None:
            report = report.unionByName(reject_report(stored, read_days(spark, rejects, REJECTS, wanted), data_type, wanted))
        return _run_now(report)
    except (PySparkException, Py4JJavaError) as error:
        text = error.java_exception.getMessage() if isinstance(error, Py4JJavaError) else str(error)
        row = (data_type, wanted, "readable", None, None, False, None, text.splitlines()[0])
        return spark.createDataFrame([row], REPORT)


def _run_now(report: DataFrame) -> DataFrame:
    """Runs the report now, so that unreadable files fail here and not later."""
    rows = report.collect()  # one row per check of one day
    return report.sparkSession.createDataFrame(rows, report.schema)
