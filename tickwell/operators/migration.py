"""Raw and aggregated files into tables of plain Parquet by date, and recomputation of past days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tickwell.functions.ticks import with_date_parts
from tickwell.operators import history
from tickwell.operators.daily import daily_prices, daily_volumes
from tickwell.schemas import DAILY_TABLE, DAY_PARTITIONS, PRICES_TABLE, RAW_PRICES, RAW_VOLUMES, VOLUMES_TABLE
from tickwell.session import path_exists
from tickwell.sources.days import as_day, read_days, replace_days

Day = str | date | None


def _dated(raw: DataFrame) -> DataFrame:
    """``date`` as the folder says, so that a row stays on the day it was stored under,
    whatever the time zone of this session; without folder columns, as the event time says."""
    folder = all(c in raw.columns for c in DAY_PARTITIONS)
    day = F.make_date(*DAY_PARTITIONS) if folder else F.to_date("event_timestamp")
    return raw.withColumns({"date": day, "timestamp": F.col("event_timestamp")})


def price_rows(raw: DataFrame) -> DataFrame:
    """Raw price ticks in the columns of the prices table."""
    return _dated(raw).select(*PRICES_TABLE.fieldNames())


def volume_rows(raw: DataFrame) -> DataFrame:
    return _dated(raw).select(*VOLUMES_TABLE.fieldNames())


def daily_rows(daily: DataFrame) -> DataFrame:
    return daily.select(*DAILY_TABLE.fieldNames())


# kind -> schema of the stored files, projection into the table
_KINDS = {
    "prices": (RAW_PRICES, price_rows),
    "volumes": (RAW_VOLUMES, volume_rows),
    "daily": (DAILY_TABLE, daily_rows),
}
_TABLE_SCHEMAS = {"prices": PRICES_TABLE, "volumes": VOLUMES_TABLE, "daily": DAILY_TABLE}


def keys_of(kind: str) -> tuple[str, ...]:
    """What names a row of a table."""
    return ("symbol", "date") if kind == "daily" else history.KEYS


def with_day_parts(schema: StructType) -> StructType:
    """The schema of files partitioned by day: date parts added where missing."""
    parts = [StructField(c, IntegerType()) for c in DAY_PARTITIONS if c not in schema.fieldNames()]
    return StructType(schema.fields + parts)


def _within(rows: DataFrame, first: date, last: date) -> DataFrame:
    """Fails the job on a row outside of the range: leaving it out would lose it in silence."""
    day = F.col("date")
    outside = F.raise_error(F.concat(F.lit(f"row outside of {first} to {last}: "), F.coalesce(day.cast("string"), F.lit("no date"))))
    return rows.withColumn("date", F.when(day.between(F.lit(first), F.lit(last)), day).otherwise(outside.cast("date")))


def migrate(spark: SparkSession, kind: str, root: str, table: str, start: Day = None, end: Day = None,
            recorded: str | None = None, committed_at: history.Moment = None) -> int:
    """Moves the days ``start`` to ``end`` of one dataset into the table at path ``table``, and
    returns how many rows they have.

    Every day of the range is replaced, also by nothing, so repeating a migration adds
    nothing. With ``recorded``, the history at that path gets what changed in these days: new and
    corrected rows, and removals of those that are gone.
    """
    first = as_day(start, spark)
    last = as_day(end, spark) if end is not None else first
    schema, project = _KINDS[kind]
    rows = _within(project(read_days(spark, root, with_day_parts(schema), first, last)), first, last)
    written = replace_days(rows, table, first, last, ("date",))
    if recorded is not None:
        history.record_changes(rows, recorded, _TABLE_SCHEMAS[kind], first, last, keys_of(kind), committed_at)
    return written


def read_table(spark: SparkSession, kind: str, table: str) -> DataFrame:
    """The rows of a table; none if nothing was moved yet."""
    schema = _TABLE_SCHEMAS[kind]
    if not path_exists(spark, table):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table).select(*schema.fieldNames())


def migrate_all(spark: SparkSession, roots: dict[str, str], tables: dict[str, str],
                start: Day = None, end: Day = None) -> None:
    for kind in _KINDS:
        migrate(spark, kind, roots[kind], tables[kind], start, end)


def backfill(spark: SparkSession, kind: str, raw_root: str, daily_root: str, start: Day = None,
             end: Day = None) -> None:
    """Recomputes the daily aggregate of a date range in one job and replaces all its days: a
    day whose ticks are gone loses its aggregate."""
    first = as_day(start, spark)
    last = as_day(end, spark) if end is not None else first
    schema = RAW_PRICES if kind == "prices" else RAW_VOLUMES
    aggregate = daily_prices if kind == "prices" else daily_volumes
    raw = read_days(spark, raw_root, schema, first, last)
    # the day of the folder, whatever the zone of this session
    daily = aggregate(raw.drop("event_timestamp", "timestamp").withColumn("event_timestamp", F.make_date(*DAY_PARTITIONS)))
    replace_days(with_date_parts(daily, "date").drop("hour"), daily_root, first, last)
