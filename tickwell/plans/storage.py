"""Partitioned files, catalog tables and migration. Each query writes to a fresh
folder of the shared storage and returns a read of what it wrote."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tickwell import jobs
from tickwell.functions import ticks as T
from tickwell.operators import analytics as A
from tickwell.operators import daily as D
from tickwell.operators import maintenance as U
from tickwell.operators import migration as M
from tickwell.plans import frames as X
from tickwell.plans.analytics import DAILY_OUT, DAILY_ROUNDED, SYMBOL
from tickwell.plans.frames import (DAILY, DAILY_CORE, ISO, LAST_DAY, QUOTES, STORED_DAILY, STORED_PRICES,
                                   STORED_VOLUMES, TICKS, plain, with_ctes)
from tickwell.plans.registry import query
from tickwell.schemas import DAILY_TABLE, DAILY_VOLUMES, PRICE_MESSAGE, RAW_PRICES, RAW_VOLUMES, VOLUMES_TABLE
from tickwell.session import fresh_dir, staged
from tickwell.sources import days as S
from tickwell.sources import inventory
from tickwell.sources import tables as C
from tickwell.sources.messages import drain_messages, publish_messages
from tickwell.streaming.pipelines import raw_prices, raw_volumes


def price_topic(spark, sf_dir):
    path = fresh_dir(spark, "price-topic")
    publish_messages(X.price_messages(spark, sf_dir), path)
    return path


def volume_topic(spark, sf_dir):
    path = fresh_dir(spark, "volume-topic")
    publish_messages(X.volume_topic(spark, sf_dir), path)
    return path


def stored_raw(spark, sf_dir, kind):
    """Raw ticks as the pipelines produce them, stored by day."""
    root = fresh_dir(spark, f"raw-{kind}")
    messages = X.price_messages(spark, sf_dir) if kind == "prices" else X.volume_topic(spark, sf_dir)
    S.write_days(raw_prices(messages) if kind == "prices" else raw_volumes(messages), root)
    return root


def span(spark, sf_dir):
    """First and last day of the events."""
    return X.table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()


# Topics -------------------------------------------------------------------

@query(with_ctes(TICKS, select="""SELECT symbol AS key, CAST(tick_id % 2 AS INT) AS partition, tick_id AS "offset",
  event_timestamp AS timestamp, price, volume, previous_close FROM ticks"""))
def to_message_envelope(spark, sf_dir):
    """The envelope, with a few fields taken back out of the JSON text by path."""
    text = F.col("value").cast("string")

    def field(name, kind):
        return F.get_json_object(text, f"$.{name}").cast(kind).alias(name)

    return plain(X.price_messages(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), "partition", "offset", "timestamp",
        field("price", "double"), field("volume", "bigint"), field("previous_close", "double")))


@query(with_ctes(QUOTES, select=f"SELECT symbol, {ISO} AS timestamp, volume, price FROM quotes"))
def volume_messages(spark, sf_dir):
    prices = X.ticks(spark, sf_dir).withColumn("timestamp", T.iso_text("event_timestamp"))
    return T.volume_messages(prices)


DRAINED = f"""SELECT kafka_offset, symbol, price, volume, timestamp,
  printf('%s - Price: $%.2f, Volume: %s, Time: %s', symbol, price, format('{{:,}}', volume), timestamp) AS line
  FROM (SELECT tick_id AS kafka_offset, symbol, price, volume, {ISO} AS timestamp FROM quotes)"""


def _drained(spark, sf_dir):
    messages = drain_messages(spark, price_topic(spark, sf_dir))
    line = F.format_string("%s - Price: $%.2f, Volume: %s, Time: %s", "symbol", "price",
                           F.format_number("volume", 0), "timestamp")
    return (T.parse_messages(messages, PRICE_MESSAGE)
            .select("kafka_offset", "symbol", "price", "volume", "timestamp", line.alias("line")))


@query(with_ctes(QUOTES, select=DRAINED))
def drain_topic_messages(spark, sf_dir):
    return _drained(spark, sf_dir)


@query(with_ctes(TICKS, select=f"""SELECT tick_id AS kafka_offset, symbol, price,
  round(price_change_pct, 8) AS price_change_pct FROM ticks WHERE symbol = '{SYMBOL}'"""))
def monitor_symbol(spark, sf_dir):
    messages = drain_messages(spark, price_topic(spark, sf_dir))
    rows = T.with_price_change(T.parse_messages(messages, PRICE_MESSAGE))
    return plain(rows.filter(F.col("symbol") == SYMBOL)
                 .select("kafka_offset", "symbol", "price", "price_change_pct"), "price_change_pct")


# Day scans ----------------------------------------------------------------

RAW_DAY = "2024-01-15"


@query(with_ctes(TICKS, STORED_PRICES, select=f"""SELECT tick_id AS kafka_offset, symbol, event_timestamp, price, high, low, volume,
  previous_close, round(price_change_pct, 8) AS price_change_pct, 2024 AS year, 1 AS month, 15 AS day,
  hour(event_timestamp)::INT AS hour FROM stored WHERE event_timestamp::DATE = DATE '{RAW_DAY}'"""))
def scan_raw_prices_day(spark, sf_dir):
    rows = S.read_days(spark, stored_raw(spark, sf_dir, "prices"), RAW_PRICES, RAW_DAY)
    return plain(rows.select("kafka_offset", "symbol", "event_timestamp", "price", "high", "low", "volume",
                             "previous_close", "price_change_pct", "year", "month", "day", "hour"),
                 "price_change_pct")


@query(with_ctes(QUOTES, STORED_VOLUMES, select=f"""SELECT tick_id AS kafka_offset, symbol, event_timestamp, volume, price
  FROM stored WHERE event_timestamp::DATE = DATE '{RAW_DAY}'"""))
def scan_raw_volumes_day(spark, sf_dir):
    rows = S.read_days(spark, stored_raw(spark, sf_dir, "volumes"), RAW_VOLUMES, RAW_DAY)
    return plain(rows.select("kafka_offset", "symbol", "event_timestamp", "volume", "price"))


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT tick_id AS kafka_offset, symbol FROM stored
  WHERE event_timestamp::DATE = (SELECT max(event_timestamp)::DATE + 1 FROM stored)"""))
def scan_missing_day_empty(spark, sf_dir):
    after = X.last_day(spark, sf_dir) + timedelta(days=1)
    rows = S.read_days(spark, stored_raw(spark, sf_dir, "volumes"), RAW_VOLUMES, after)
    return rows.select("kafka_offset", "symbol")


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT year(event_timestamp)::INT AS year, month(event_timestamp)::INT AS month,
  day(event_timestamp)::INT AS day, count(*) AS rows, TRUE AS has_files FROM stored GROUP BY ALL"""))
def partition_inventory(spark, sf_dir):
    found = S.partition_inventory(spark, stored_raw(spark, sf_dir, "volumes"), RAW_VOLUMES)
    return found.select("year", "month", "day", "rows",
                        ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT name, exists, exists AND (SELECT count(*) FROM stored) > 0 AS has_files
  FROM (VALUES ('raw_volumes', TRUE), ('lakehouse_volumes', FALSE)) t(name, exists)"""))
def path_inventory(spark, sf_dir):
    found = inventory.path_inventory(spark, {"raw_volumes": stored_raw(spark, sf_dir, "volumes"),
                                     "lakehouse_volumes": fresh_dir(spark, "absent")})
    return found.select("name", "exists", (F.col("files") > 0).alias("has_files"))


# Daily files --------------------------------------------------------------

def _stored_daily(spark, root):
    return spark.read.schema(M.with_day_parts(DAILY_TABLE)).parquet(root).select(*DAILY_TABLE.fieldNames())


@query(with_ctes(DAILY, select=DAILY_OUT))
def daily_overwrite_idempotent(spark, sf_dir):
    """Writes every day, then one day again: its folder is replaced, the rest stay."""
    root = fresh_dir(spark, "daily")
    rows = T.with_date_parts(X.daily(spark, sf_dir), "date").drop("hour")
    S.overwrite_days(rows, root)
    S.overwrite_days(rows.filter(F.col("date") == F.lit(RAW_DAY).cast("date")), root)
    return plain(_stored_daily(spark, root), *DAILY_ROUNDED)


@query(with_ctes(STORED_DAILY, select=DAILY_OUT))
def backfill_daily(spark, sf_dir):
    first, last = span(spark, sf_dir)
    root = fresh_dir(spark, "daily")
    M.backfill(spark, "prices", stored_raw(spark, sf_dir, "prices"), root, first, last)
    return plain(_stored_daily(spark, root), *DAILY_ROUNDED)


VOLUME_DAYS = """SELECT symbol, event_timestamp::DATE AS date, sum(volume)::BIGINT AS total_volume,
  round(avg(volume), 8) AS avg_volume, max(volume) AS max_volume, min(volume) AS min_volume,
  round(avg(price), 8) AS avg_price, count(*) AS record_count FROM stored GROUP BY ALL"""


@query(with_ctes(QUOTES, STORED_VOLUMES, select=VOLUME_DAYS))
def backfill_daily_volumes(spark, sf_dir):
    first, last = span(spark, sf_dir)
    root = fresh_dir(spark, "daily-volumes")
    M.backfill(spark, "volumes", stored_raw(spark, sf_dir, "volumes"), root, first, last)
    stored = spark.read.schema(M.with_day_parts(DAILY_VOLUMES)).parquet(root).select(*DAILY_VOLUMES.fieldNames())
    return plain(stored, "avg_volume", "avg_price")


# Tables -------------------------------------------------------------------

@query(with_ctes(DAILY_CORE, select=f"""SELECT symbol, date, round(avg_price, 8) AS avg_price, total_volume
  FROM daily WHERE symbol = '{SYMBOL}' AND date >= {LAST_DAY} - 7"""))
def pruned_symbol_7d(spark, sf_dir):
    """Reads a table partitioned by symbol and date; both conditions prune folders."""
    path = fresh_dir(spark, "daily-table")
    rows = X.daily_core(spark, sf_dir)
    S.write_days(rows, path, ("symbol", "date"))
    stored = spark.read.schema(rows.schema).parquet(path)
    return plain(A.symbol_days(stored, SYMBOL, X.last_day(spark, sf_dir)), "avg_price")


@query(with_ctes(DAILY, select="""SELECT 'stock_prices' AS table_name, count(*) AS rows,
  min(event_timestamp)::DATE AS first_date, max(event_timestamp)::DATE AS last_date FROM ticks
  UNION ALL SELECT 'stock_volumes', count(*), min(event_timestamp)::DATE, max(event_timestamp)::DATE FROM ticks
  UNION ALL SELECT 'daily_aggregates', count(*), min(date), max(date) FROM daily"""))
def create_tables(spark, sf_dir):
    """Creates the three tables (twice, the second time without effect) and fills them."""
    warehouse = fresh_dir(spark, "warehouse")
    database = f"tickwell_{warehouse.rsplit('-', 1)[1]}"
    C.create_all_tables(spark, database, warehouse)
    names = C.create_all_tables(spark, database, warehouse)
    priced = X.priced_ticks(spark, sf_dir)
    with_zone = priced.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    for name, rows in zip(names, (M.price_rows(with_zone), M.volume_rows(with_zone),
                                  M.daily_rows(D.daily_prices(priced)))):
        C.append_to_table(rows, name)
    out = None
    for name in names:
        summary = spark.table(name).agg(
            F.lit(name.split(".")[1]).alias("table_name"), F.count("*").alias("rows"),
            F.min("date").alias("first_date"), F.max("date").alias("last_date"))
        out = summary if out is None else out.unionAll(summary)
    return out


# Migration: every migration runs twice and must not add rows the second time.

def _migrated(spark, sf_dir, kind, root):
    first, last = span(spark, sf_dir)
    target = fresh_dir(spark, f"table-{kind}")
    for _ in range(2):
        M.migrate(spark, kind, root, target, first, last)
    return plain(M.read_table(spark, kind, target))


PRICES_OUT = """SELECT symbol, event_timestamp AS timestamp, event_timestamp::DATE AS date, price, open, high, low,
  volume, previous_close, price_change, round(price_change_pct, 8) AS price_change_pct, market_cap, currency
  FROM stored"""


@query(with_ctes(TICKS, STORED_PRICES, select=PRICES_OUT))
def migrate_prices(spark, sf_dir):
    rows = _migrated(spark, sf_dir, "prices", stored_raw(spark, sf_dir, "prices"))
    return plain(rows, "price_change_pct")


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT symbol, event_timestamp AS timestamp, event_timestamp::DATE AS date,
  volume, price FROM stored"""))
def migrate_volumes(spark, sf_dir):
    return _migrated(spark, sf_dir, "volumes", stored_raw(spark, sf_dir, "volumes"))


@query(with_ctes(DAILY, select=DAILY_OUT))
def migrate_daily_aggregates(spark, sf_dir):
    root = fresh_dir(spark, "daily")
    S.overwrite_days(T.with_date_parts(X.daily(spark, sf_dir), "date").drop("hour"), root)
    return plain(_migrated(spark, sf_dir, "daily", root), *DAILY_ROUNDED)


# Upkeep -------------------------------------------------------------------

@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT event_timestamp::DATE AS date, count(*) AS rows, 1::BIGINT AS files,
  day(event_timestamp::DATE) % 2 = 0 AS untouched FROM stored GROUP BY ALL"""))
def compact_small_files(spark, sf_dir):
    """A table whose odd days came in four appends and whose even days in one. The small files of a day
    become one; days of one file keep it."""
    path = fresh_dir(spark, "small-files")
    rows = M.volume_rows(spark.read.schema(RAW_VOLUMES).parquet(stored_raw(spark, sf_dir, "volumes")))
    odd = F.dayofmonth("date") % 2 == 1
    for k in range(4):
        S.write_days(rows.where(odd & (F.pmod(F.xxhash64("symbol", "timestamp"), F.lit(4)) == k)), path, ("date",))
    S.write_days(rows.where(~odd), path, ("date",))
    before = staged(U.files(spark, path, VOLUMES_TABLE), "before")
    U.compact(spark, path, VOLUMES_TABLE)
    stored = spark.read.schema(VOLUMES_TABLE).parquet(path)
    counted = stored.groupBy("date", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    found = counted.join(before.select("file", F.lit(1).alias("old")), "file", "left").groupBy("date")
    return found.agg(F.sum("n").alias("rows"), F.count("*").alias("files"), (F.count("old") == F.count("*")).alias("untouched"))


@query("""SELECT * FROM (VALUES ('stock_prices', 'compact', 'ok'), ('stock_volumes', 'compact', 'ok'), ('daily_aggregates', 'compact', 'ok'),
  ('history/stock_volumes', 'expire', 'ok'), ('history/stock_volumes', 'compact', 'ok')) t("table", step, status)
  WHERE (SELECT count(*) FROM events) > 0""")
def optimize_all(spark, sf_dir):
    """Upkeep of three migrated tables and a history, side by side, with a status for each step."""
    first, last = span(spark, sf_dir)
    root, daily = fresh_dir(spark, "optimized"), fresh_dir(spark, "daily")
    S.overwrite_days(T.with_date_parts(X.daily(spark, sf_dir), "date").drop("hour"), daily)
    roots = {"prices": stored_raw(spark, sf_dir, "prices"), "volumes": stored_raw(spark, sf_dir, "volumes"), "daily": daily}
    for kind, name in jobs.KINDS.items():
        M.migrate(spark, kind, roots[kind], jobs.table_path(root, kind), first, last,
                  jobs.history_path(root, name) if kind == "volumes" else None)
    return U.run_steps(spark, jobs.upkeep_steps(spark, root, first, last)).select("table", "step", "status")
