"""Tick frames derived from the given tables, each with its SQL twin.

``events`` rows stand for ticks: five event types play five symbols. Hourly open,
high, low and the previous day's close, which a feed would deliver, are computed.
``lineitem`` joined with ``part`` gives trades: 25 brands over seven years.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwell.functions.ticks import iso_text, to_envelope, with_price_change
from tickwell.operators.daily import CORE_MEASURES, daily_prices
from tickwell.operators.lookup import lookup_join, settled
from tickwell.schemas import PRICE_MESSAGE, VOLUME_MESSAGE
from tickwell.session import cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# Ticks --------------------------------------------------------------------

QUOTES = """quotes AS (
  SELECT event_id AS tick_id, event_type AS symbol, ts AS event_timestamp, value AS price,
         CAST(json_extract(props, '$.k') AS BIGINT) AS volume
  FROM events)"""


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of a tick that needs no other row: id, symbol, time, price, volume."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tick_id"),
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"))


TICKS = QUOTES + """,
hourly AS (
  SELECT symbol, date_trunc('hour', event_timestamp) AS hour_start,
         arg_min(price, event_timestamp) AS open, max(price) AS high, min(price) AS low
  FROM quotes GROUP BY ALL),
closes AS (
  SELECT symbol, event_timestamp::DATE AS date, arg_max(price, event_timestamp) AS close
  FROM quotes GROUP BY ALL),
previous AS (
  SELECT symbol, date, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS previous_close
  FROM closes),
ticks AS (
  SELECT q.tick_id, q.symbol, q.event_timestamp, q.price, h.open, h.high, h.low, q.volume,
         p.previous_close, CAST(NULL AS DOUBLE) AS market_cap, 'USD' AS currency,
         q.price - p.previous_close AS price_change,
         (q.price - p.previous_close) / nullif(p.previous_close, 0) * 100 AS price_change_pct
  FROM quotes q
  JOIN hourly h ON h.symbol = q.symbol AND h.hour_start = date_trunc('hour', q.event_timestamp)
  JOIN previous p ON p.symbol = q.symbol AND p.date = q.event_timestamp::DATE)"""


def _moment(day: date, plus: int = 0) -> Column:
    return F.lit(datetime.combine(day, time()) + timedelta(days=plus)).cast("timestamp_ntz")


def _between(df: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Rows of the days ``first`` to ``last``, as plain bounds on time that reach the files."""
    if first is not None:
        df = df.filter(F.col("event_timestamp") >= _moment(first))
    if last is not None:
        df = df.filter(F.col("event_timestamp") < _moment(last, 1))
    return df


def _closes_before(rows: DataFrame, first: date, symbols: DataFrame) -> DataFrame:
    """symbol, close: the newest price of each symbol before a day. The day before is read;
    only for symbols without a row in it, all earlier ones."""
    def newest(df: DataFrame) -> DataFrame:
        return df.groupBy("symbol").agg(F.max_by("price", "event_timestamp").alias("close"))

    found = cut(newest(_between(rows, first - timedelta(days=1), first - timedelta(days=1))))
    absent = cut(symbols.join(found.select(F.col("symbol").alias("known")), F.col("symbol").eqNullSafe(F.col("known")), "left_anti"))
    if absent.isEmpty():
        return found
    older = _between(rows, None, first - timedelta(days=2)).join(
        absent.select(F.col("symbol").alias("absent")), F.col("symbol").eqNullSafe(F.col("absent")), "left_semi")
    return found.unionByName(newest(older))


def ticks(spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Full price ticks with hourly bars and the previous day's close, of all days or of
    the days ``start`` to ``end``: then only those, and the day before, are read.

    One pass computes bars, at most one row per symbol and hour; the previous close is
    the newest price of any earlier day. Bars join back, so no window runs over ticks.
    """
    rows = quotes(spark, sf_dir)
    base = _between(rows, start, end).withColumn("hour_start", F.date_trunc("hour", "event_timestamp"))
    hourly = base.groupBy("symbol", "hour_start").agg(
        F.min_by("price", "event_timestamp").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "event_timestamp").alias("last_price"),
        F.max("event_timestamp").alias("last_at"))
    day = F.unix_date(F.to_date("hour_start"))
    earlier_days = Window.partitionBy("symbol").orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
    bars = hourly.select("symbol", "hour_start", "open", "high", "low",
                         F.max_by("last_price", "last_at").over(earlier_days).alias("previous_close"))
    if start is not None:
        bars = settled(bars)
        before = _closes_before(rows, start, bars.select("symbol").distinct()).withColumnRenamed("symbol", "of")
        bars = bars.join(before, F.col("symbol").eqNullSafe(F.col("of")), "left").withColumn(
            "previous_close", F.coalesce("previous_close", "close")).drop("of", "close")
    return lookup_join(base, bars, ["symbol", "hour_start"]).select(
        "tick_id", "symbol", "event_timestamp", "price", "open", "high", "low", "volume",
        "previous_close", F.lit(None).cast("double").alias("market_cap"), F.lit("USD").alias("currency"))


def priced_ticks(spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None) -> DataFrame:
    return with_price_change(ticks(spark, sf_dir, start, end))


# What the raw pipelines store: ticks that pass the validity filter.
VALID = "symbol IS NOT NULL AND price IS NOT NULL AND price > 0"
STORED_PRICES = f"stored AS (SELECT * FROM ticks WHERE {VALID})"
STORED_VOLUMES = f"stored AS (SELECT * FROM quotes WHERE {VALID})"


def last_day(spark: SparkSession, sf_dir: str) -> date:
    """The fixture's stand-in for the current date: the day of the newest event."""
    return table(spark, sf_dir, "events").agg(F.to_date(F.max("ts"))).first()[0]


LAST_DAY = "(SELECT max(ts)::DATE FROM events)"


# Daily rows ---------------------------------------------------------------

DAILY_CORE = QUOTES + """,
daily AS (
  SELECT symbol, event_timestamp::DATE AS date, avg(price) AS avg_price, max(price) AS max_price,
         min(price) AS min_price, sum(volume)::BIGINT AS total_volume, count(*) AS record_count,
         max(price) - min(price) AS price_range,
         (max(price) - min(price)) / avg(price) * 100 AS price_range_pct
  FROM quotes GROUP BY ALL)"""

def _daily_sql(source: str) -> str:
    return f"""daily AS (
  SELECT symbol, event_timestamp::DATE AS date, avg(price) AS avg_price, max(price) AS max_price,
         min(price) AS min_price, max(high) AS max_high, min(low) AS min_low,
         sum(volume)::BIGINT AS total_volume, count(*) AS record_count,
         avg(price_change) AS avg_price_change, avg(price_change_pct) AS avg_price_change_pct,
         max(price) - min(price) AS price_range,
         (max(price) - min(price)) / avg(price) * 100 AS price_range_pct
  FROM {source} GROUP BY ALL)"""


DAILY = f"{TICKS},\n{_daily_sql('ticks')}"
STORED_DAILY = f"{TICKS},\n{STORED_PRICES},\n{_daily_sql('stored')}"


def daily_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows without the measures that need bars or the previous close."""
    return daily_prices(quotes(spark, sf_dir), measures=CORE_MEASURES)


def daily(spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None) -> DataFrame:
    return daily_prices(priced_ticks(spark, sf_dir, start, end))


# Trades -------------------------------------------------------------------

TRADES = """trades AS (
  SELECT p.p_brand AS symbol, l.l_shipdate AS event_timestamp,
         l.l_extendedprice / l.l_quantity AS price, CAST(l.l_quantity AS BIGINT) AS volume,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
daily AS (
  SELECT symbol, event_timestamp::DATE AS date, avg(price) AS avg_price, max(price) AS max_price,
         min(price) AS min_price, sum(volume)::BIGINT AS total_volume, count(*) AS record_count
  FROM trades GROUP BY ALL)"""


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return line.join(part, "l_partkey").select(
        F.col("p_brand").alias("symbol"),
        F.col("l_shipdate").alias("event_timestamp"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        "l_orderkey", "l_linenumber")


def daily_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_prices(trades(spark, sf_dir), measures=CORE_MEASURES)


def last_trade_day(spark: SparkSession, sf_dir: str) -> date:
    return table(spark, sf_dir, "lineitem").agg(F.to_date(F.max("l_shipdate"))).first()[0]


LAST_TRADE_DAY = "(SELECT max(l_shipdate)::DATE FROM lineitem)"


# Damaged ticks ------------------------------------------------------------
# Fixed rules; the first price rule that hits counts.

DIRTY = QUOTES + """,
dirty AS (
  SELECT q.tick_id, c.copy, CASE WHEN tick_id % 31 = 0 THEN NULL ELSE symbol END AS symbol,
         event_timestamp,
         CASE WHEN tick_id % 50 = 7 THEN NULL WHEN tick_id % 97 = 5 THEN -price
              WHEN tick_id % 101 = 3 THEN 0.0 ELSE price END AS price,
         CASE WHEN tick_id % 211 = 9 THEN -volume ELSE volume END AS volume,
         tick_id + c.copy * 1000000000000 AS kafka_offset,
         tick_id % 401 = 11 AS cut_short, tick_id % 503 = 17 AS bad_time
  FROM quotes q JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR q.tick_id % 13 = 1)"""


def _every(n: int, rest: int) -> Column:
    return F.col("tick_id") % n == rest


def dirty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with missing symbols and prices, bad signs and repeated deliveries."""
    damaged = quotes(spark, sf_dir).withColumns({
        "symbol": F.when(~_every(31, 0), F.col("symbol")),
        "price": F.when(_every(50, 7), None).when(_every(97, 5), -F.col("price"))
                  .when(_every(101, 3), 0.0).otherwise(F.col("price")),
        "volume": F.when(_every(211, 9), -F.col("volume")).otherwise(F.col("volume")),
    })
    copies = F.when(_every(13, 1), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (damaged.withColumn("copy", F.explode(copies))
            .withColumn("kafka_offset", F.col("tick_id") + F.col("copy") * F.lit(1_000_000_000_000)))


# Messages -----------------------------------------------------------------

def _publish(rows: DataFrame, schema, offset: Column) -> DataFrame:
    return to_envelope(
        rows.withColumn("timestamp", iso_text("event_timestamp")), schema,
        partition=F.pmod(F.col("tick_id"), F.lit(2)), offset=offset,
        timestamp=F.col("event_timestamp"))


def price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _publish(ticks(spark, sf_dir), PRICE_MESSAGE, F.col("tick_id"))


def volume_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _publish(quotes(spark, sf_dir), VOLUME_MESSAGE, F.col("tick_id"))


def dirty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged ticks as volume-topic messages (symbol, timestamp, volume, price), some
    cut short in the middle of the JSON text and some with a time that is no time."""
    rows = dirty_ticks(spark, sf_dir).withColumn(
        "timestamp", F.when(_every(503, 17), F.lit("not-a-time")).otherwise(iso_text("event_timestamp")))
    body = F.to_json(F.struct(*VOLUME_MESSAGE.fieldNames()))
    text = F.when(_every(401, 11), F.substring(body, 1, 20)).otherwise(body)
    return rows.select(
        F.col("symbol").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.pmod(F.col("tick_id"), F.lit(2)).cast("int").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("event_timestamp").cast("timestamp").alias("timestamp"))


ISO = "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


# Output helpers -----------------------------------------------------------

def plain(df: DataFrame, *rounded: str) -> DataFrame:
    """Timestamps without zone, and the named ratios and averages rounded to 8 digits,
    so that engines that add in another order still agree."""
    kinds = dict(df.dtypes)
    changes = {c: F.col(c).cast("timestamp_ntz") for c, kind in kinds.items() if kind == "timestamp"}
    changes |= {c: F.round(c, 8) for c in rounded}
    return df.withColumns(changes) if changes else df
