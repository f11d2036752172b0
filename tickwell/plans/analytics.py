"""Aggregations, trailing summaries, windows and top-k over ticks and daily rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tickwell.functions import ticks as T
from tickwell.functions.ticks import iso_text, with_date_parts, with_price_change
from tickwell.operators import analytics as A
from tickwell.operators import daily as D
from tickwell.operators.running import cumulative_volume as running_volume
from tickwell.plans import frames as X
from tickwell.plans.frames import DAILY, DAILY_CORE, LAST_DAY, QUOTES, TICKS, TRADES, plain, with_ctes
from tickwell.plans.registry import query
from tickwell.sources.tables import register_views, row_count

SYMBOL = "purchase"
OTHER = "view"
NEWEST = ("event_timestamp", "tick_id")

DAILY_OUT = """SELECT symbol, date, round(avg_price, 8) AS avg_price, max_price, min_price, max_high, min_low,
  total_volume, record_count, round(avg_price_change, 8) AS avg_price_change,
  round(avg_price_change_pct, 8) AS avg_price_change_pct, round(price_range, 8) AS price_range,
  round(price_range_pct, 8) AS price_range_pct FROM daily"""
DAILY_ROUNDED = ("avg_price", "avg_price_change", "avg_price_change_pct", "price_range", "price_range_pct")


# Aggregates ---------------------------------------------------------------

@query(with_ctes(DAILY, select=DAILY_OUT))
def daily_prices(spark, sf_dir):
    return plain(X.daily(spark, sf_dir), *DAILY_ROUNDED)


@query(with_ctes(TICKS, select=f"""SELECT symbol, event_timestamp::DATE AS date,
  round(avg(price), 8) AS avg_price, max(price) AS max_price, min(price) AS min_price,
  sum(volume)::BIGINT AS total_volume, count(*) AS record_count,
  round(max(price) - min(price), 8) AS price_range,
  round((max(price) - min(price)) / avg(price) * 100, 8) AS price_range_pct
  FROM ticks GROUP BY ALL"""))
def daily_prices_from_string_ts(spark, sf_dir):
    """The frame has only the message's text time, so the date comes from that."""
    rows = (X.quotes(spark, sf_dir).withColumn("timestamp", iso_text("event_timestamp"))
            .drop("event_timestamp"))
    return plain(D.daily_prices(rows, measures=D.CORE_MEASURES), "avg_price", "price_range", "price_range_pct")


@query(with_ctes(QUOTES, select="""SELECT symbol, event_timestamp::DATE AS date,
  sum(volume)::BIGINT AS total_volume, round(avg(volume), 8) AS avg_volume, max(volume) AS max_volume,
  min(volume) AS min_volume, round(avg(price), 8) AS avg_price, count(*) AS record_count
  FROM quotes GROUP BY ALL"""))
def daily_volumes(spark, sf_dir):
    return plain(D.daily_volumes(X.quotes(spark, sf_dir)), "avg_volume", "avg_price")


@query(with_ctes(TICKS, select="""SELECT symbol, tick_id, event_timestamp, price, price_change,
  round(price_change_pct, 8) AS price_change_pct, volume
  FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_timestamp DESC, tick_id DESC) = 1"""))
def latest_price_per_symbol(spark, sf_dir):
    rows = X.priced_ticks(spark, sf_dir).select(
        "symbol", "tick_id", "event_timestamp", "price", "price_change", "price_change_pct", "volume")
    return plain(D.latest_per_symbol(rows), "price_change_pct")


@query("SELECT count(*) AS row_count FROM events")
def table_row_count(spark, sf_dir):
    return row_count(X.quotes(spark, sf_dir))


# Row-level transforms -----------------------------------------------------

@query(with_ctes(TICKS, select="""SELECT tick_id, price, previous_close, round(price_change, 8) AS price_change,
  round(price_change_pct, 8) AS price_change_pct FROM ticks"""))
def price_change(spark, sf_dir):
    rows = with_price_change(X.ticks(spark, sf_dir))
    return plain(rows.select("tick_id", "price", "previous_close", "price_change", "price_change_pct"),
                 "price_change", "price_change_pct")


@query(with_ctes(QUOTES, select="""SELECT tick_id, event_timestamp, year(event_timestamp)::INT AS year,
  month(event_timestamp)::INT AS month, day(event_timestamp)::INT AS day, hour(event_timestamp)::INT AS hour
  FROM quotes"""))
def partition_columns(spark, sf_dir):
    return with_date_parts(X.quotes(spark, sf_dir).select("tick_id", "event_timestamp"))


@query(with_ctes(X.DIRTY, select="""SELECT tick_id, copy, symbol, price, volume FROM dirty
  WHERE symbol IS NOT NULL AND price IS NOT NULL AND price > 0"""))
def valid_ticks(spark, sf_dir):
    return T.valid_ticks(X.dirty_ticks(spark, sf_dir)).select("tick_id", "copy", "symbol", "price", "volume")


# Event-time windows -------------------------------------------------------

def windows_sql(seconds: int, slide: int, source: str = "ticks") -> str:
    """Rows of ``source`` once per window that covers them."""
    covers = ", ".join(f"({i})" for i in range(seconds // slide))
    return f"""windowed AS (
  SELECT t.*, make_timestamp((floor(epoch(event_timestamp) / {slide})::BIGINT - w.i) * {slide * 1_000_000}) AS window_start,
    make_timestamp(((floor(epoch(event_timestamp) / {slide})::BIGINT - w.i) * {slide} + {seconds}) * 1000000) AS window_end
  FROM {source} t CROSS JOIN (VALUES {covers}) w(i))"""


WINDOW_PRICES_OUT = """SELECT symbol, window_start, window_end, round(avg(price), 8) AS avg_price,
  max(price) AS max_price, min(price) AS min_price, max(high) AS max_high, min(low) AS min_low,
  sum(volume)::BIGINT AS total_volume, count(*) AS record_count FROM windowed"""
WINDOW_VOLUMES_OUT = """SELECT symbol, window_start, window_end, sum(volume)::BIGINT AS total_volume,
  round(avg(volume), 8) AS avg_volume, max(volume) AS max_volume, round(avg(price), 8) AS avg_price,
  count(*) AS record_count FROM windowed"""
PER_WINDOW = " GROUP BY symbol, window_start, window_end"


@query(with_ctes(TICKS, windows_sql(60, 30), select=WINDOW_PRICES_OUT + PER_WINDOW))
def window_prices_sliding(spark, sf_dir):
    return plain(D.window_prices(X.ticks(spark, sf_dir), "1 minute", "30 seconds"), "avg_price")


@query(with_ctes(TICKS, windows_sql(300, 300), select=WINDOW_PRICES_OUT + PER_WINDOW))
def window_prices_tumbling(spark, sf_dir):
    return plain(D.window_prices(X.ticks(spark, sf_dir), "5 minutes", None), "avg_price")


@query(with_ctes(QUOTES, windows_sql(60, 30, "quotes"), select=WINDOW_VOLUMES_OUT + PER_WINDOW))
def window_volumes_sliding(spark, sf_dir):
    return plain(D.window_volumes(X.quotes(spark, sf_dir), "1 minute", "30 seconds"), "avg_volume", "avg_price")


# Query corpus over raw prices ---------------------------------------------

@query(with_ctes(TICKS, select=f"""SELECT symbol, price, event_timestamp, round(price_change, 8) AS price_change,
  round(price_change_pct, 8) AS price_change_pct FROM ticks WHERE event_timestamp::DATE = {LAST_DAY}
  ORDER BY event_timestamp DESC, tick_id DESC LIMIT 100"""))
def latest_prices(spark, sf_dir):
    today = X.last_day(spark, sf_dir)
    prices = X.priced_ticks(spark, sf_dir, today, today).withColumn("date", F.to_date("event_timestamp"))
    newest = A.latest_prices(prices, today, 100, order=NEWEST)
    return plain(newest.select("symbol", "price", "event_timestamp", "price_change", "price_change_pct"),
                 "price_change", "price_change_pct")


def _dated_quotes(spark, sf_dir):
    return X.quotes(spark, sf_dir).withColumn("date", F.to_date("event_timestamp"))


@query(with_ctes(QUOTES, select=f"""SELECT symbol, price, event_timestamp FROM quotes
  WHERE symbol = '{SYMBOL}' AND event_timestamp::DATE = {LAST_DAY}
  ORDER BY event_timestamp DESC, tick_id DESC LIMIT 10"""))
def latest_prices_symbol(spark, sf_dir):
    newest = A.latest_prices(_dated_quotes(spark, sf_dir), X.last_day(spark, sf_dir), 10, SYMBOL, order=NEWEST)
    return newest.select("symbol", "price", "event_timestamp")


@query(with_ctes(QUOTES, select=f"""SELECT symbol, round(avg(price), 8) AS avg_price, max(price) AS max_price,
  min(price) AS min_price FROM quotes WHERE event_timestamp::DATE = {LAST_DAY} GROUP BY symbol"""))
def intraday_summary(spark, sf_dir):
    return plain(A.intraday_summary(_dated_quotes(spark, sf_dir), X.last_day(spark, sf_dir)), "avg_price")


@query(with_ctes(QUOTES, select=f"""SELECT symbol, round(avg(price), 8) AS avg_price FROM quotes
  WHERE event_timestamp::DATE >= {LAST_DAY} - 7 GROUP BY symbol"""))
def avg_raw_price_7d(spark, sf_dir):
    return plain(A.avg_raw_price(_dated_quotes(spark, sf_dir), X.last_day(spark, sf_dir)), "avg_price")


@query(with_ctes(QUOTES, select="""SELECT tick_id, symbol, event_timestamp, volume,
  (sum(volume) OVER (PARTITION BY symbol ORDER BY event_timestamp, tick_id
                     ROWS UNBOUNDED PRECEDING))::BIGINT AS cumulative_volume FROM quotes"""))
def cumulative_volume(spark, sf_dir):
    return running_volume(X.quotes(spark, sf_dir))


# Query corpus over daily rows ---------------------------------------------

@query(with_ctes(DAILY_CORE, select=f"""SELECT symbol, date, round(avg_price, 8) AS avg_price, max_price, min_price,
  total_volume, round(price_range, 8) AS price_range, round(price_range_pct, 8) AS price_range_pct
  FROM daily WHERE symbol = '{SYMBOL}' ORDER BY date DESC LIMIT 30"""))
def daily_for_symbol(spark, sf_dir):
    return plain(A.daily_for_symbol(X.daily_core(spark, sf_dir), SYMBOL, 30),
                 "avg_price", "price_range", "price_range_pct")


@query(with_ctes(DAILY, select=f"{DAILY_OUT} WHERE date = {LAST_DAY}"))
def daily_today(spark, sf_dir):
    today = X.last_day(spark, sf_dir)
    return plain(A.daily_today(X.daily(spark, sf_dir, today, today), today), *DAILY_ROUNDED)


@query(with_ctes(DAILY_CORE, select=f"""SELECT symbol, date, round(avg_price, 8) AS avg_price, max_price, min_price,
  total_volume, round(price_range_pct, 8) AS price_range_pct FROM daily WHERE date >= {LAST_DAY} - 7"""))
def daily_summary_7d(spark, sf_dir):
    return plain(A.daily_summary(X.daily_core(spark, sf_dir), X.last_day(spark, sf_dir)),
                 "avg_price", "price_range_pct")


@query(with_ctes(DAILY_CORE, select=f"""SELECT date, round(avg_price, 8) AS avg_price, max_price, min_price,
  round(price_range, 8) AS price_range, total_volume FROM daily
  WHERE symbol = '{SYMBOL}' AND date >= {LAST_DAY} - 30"""))
def price_trend_30d(spark, sf_dir):
    return plain(A.price_trend(X.daily_core(spark, sf_dir), SYMBOL, X.last_day(spark, sf_dir)),
                 "avg_price", "price_range")


@query(with_ctes(DAILY_CORE, select=f"""SELECT symbol, round(avg(avg_price), 8) AS avg_daily_price,
  max(max_price) AS max_price_7d, min(min_price) AS min_price_7d, sum(total_volume)::BIGINT AS total_volume_7d
  FROM daily WHERE date >= {LAST_DAY} - 7 GROUP BY symbol"""))
def avg_price_7d(spark, sf_dir):
    return plain(A.avg_price_rollup(X.daily_core(spark, sf_dir), X.last_day(spark, sf_dir)), "avg_daily_price")


@query(with_ctes(DAILY_CORE, select=f"""SELECT symbol, sum(total_volume)::BIGINT AS total_volume FROM daily
  WHERE date = {LAST_DAY} GROUP BY symbol ORDER BY total_volume DESC, symbol LIMIT 5"""))
def top_volume_today(spark, sf_dir):
    return A.top_volume_today(X.daily_core(spark, sf_dir), X.last_day(spark, sf_dir))


@query(with_ctes(TRADES, select=f"""SELECT symbol, sum(total_volume)::BIGINT AS total_volume_7d FROM daily
  WHERE date >= {X.LAST_TRADE_DAY} - 7 GROUP BY symbol ORDER BY total_volume_7d DESC, symbol LIMIT 10"""))
def top_volume_7d(spark, sf_dir):
    return A.top_volume(X.daily_trades(spark, sf_dir), X.last_trade_day(spark, sf_dir))


MOVING = """SELECT symbol, date, round(avg_price, 8) AS avg_price, round(avg(avg_price) OVER (
  PARTITION BY symbol ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS moving_avg_7d
  FROM daily"""


@query(with_ctes(DAILY_CORE, select=f"{MOVING} WHERE date >= {LAST_DAY} - 30"))
def moving_avg_7d(spark, sf_dir):
    return plain(A.moving_average(X.daily_core(spark, sf_dir), X.last_day(spark, sf_dir)),
                 "avg_price", "moving_avg_7d")


@query(with_ctes(DAILY_CORE, select=f"{MOVING} WHERE date >= {LAST_DAY} - 30 AND symbol = '{SYMBOL}'"))
def moving_avg_7d_symbol(spark, sf_dir):
    return plain(A.moving_average(X.daily_core(spark, sf_dir), X.last_day(spark, sf_dir), symbol=SYMBOL),
                 "avg_price", "moving_avg_7d")


@query(with_ctes(DAILY, select=f"""SELECT symbol, round(avg(avg_price_change_pct), 8) AS avg_daily_change_pct,
  round(stddev_samp(avg_price_change_pct), 8) AS volatility,
  round(max(avg_price_change_pct), 8) AS max_daily_change_pct,
  round(min(avg_price_change_pct), 8) AS min_daily_change_pct
  FROM daily WHERE date >= {LAST_DAY} - 30 GROUP BY symbol"""))
def volatility_30d(spark, sf_dir):
    today = X.last_day(spark, sf_dir)
    return plain(A.volatility(X.daily(spark, sf_dir, today - timedelta(days=30), today), today),
                 "avg_daily_change_pct", "volatility", "max_daily_change_pct", "min_daily_change_pct")


@query(with_ctes(DAILY_CORE, select=f"""SELECT round(CASE WHEN count(*) > 1 THEN corr(a.avg_price, b.avg_price) END, 8)
  AS price_correlation FROM daily a JOIN daily b ON a.date = b.date
  WHERE a.symbol = '{SYMBOL}' AND b.symbol = '{OTHER}' AND a.date >= {LAST_DAY} - 30"""))
def symbol_correlation(spark, sf_dir):
    return plain(A.symbol_correlation(X.daily_core(spark, sf_dir), SYMBOL, OTHER, X.last_day(spark, sf_dir)),
                 "price_correlation")


@query(with_ctes(DAILY_CORE, select=f"""SELECT symbol, count(*) AS trading_days,
  round(avg(total_volume), 8) AS avg_daily_volume, max(total_volume) AS max_daily_volume,
  min(total_volume) AS min_daily_volume,
  percentile_cont(0.5) WITHIN GROUP (ORDER BY total_volume::DOUBLE) AS median_volume
  FROM daily WHERE date >= {LAST_DAY} - 30 GROUP BY symbol"""))
def volume_distribution(spark, sf_dir):
    return plain(A.volume_distribution(X.daily_core(spark, sf_dir), X.last_day(spark, sf_dir)), "avg_daily_volume")


UNUSUAL = """SELECT d.date, d.symbol, d.total_volume, round(s.avg_volume, 8) AS avg_volume,
  round(s.stddev_volume, 8) AS stddev_volume, round(d.total_volume / s.avg_volume, 8) AS volume_multiplier
  FROM daily d JOIN stats s ON s.symbol = d.symbol WHERE d.total_volume > s.avg_volume * 2"""
STATS = "stats AS (SELECT symbol, avg(total_volume) AS avg_volume, stddev_samp(total_volume) AS stddev_volume FROM daily"


@query(with_ctes(TRADES, f"{STATS} WHERE date >= {X.LAST_TRADE_DAY} - 30 GROUP BY symbol)",
                 select=f"{UNUSUAL} AND d.date >= {X.LAST_TRADE_DAY} - 7"))
def unusual_volume_days(spark, sf_dir):
    days = A.unusual_volume_days(X.daily_trades(spark, sf_dir), X.last_trade_day(spark, sf_dir))
    return plain(days, "avg_volume", "stddev_volume", "volume_multiplier")


@query(with_ctes(TRADES, f"{STATS} GROUP BY symbol)", select=UNUSUAL))
def unusual_volume_days_all(spark, sf_dir):
    """Against the mean of the whole history, over all days."""
    days = A.unusual_volume_days(X.daily_trades(spark, sf_dir), stats_days=None, recent_days=None)
    return plain(days, "avg_volume", "stddev_volume", "volume_multiplier")


@query(with_ctes(TRADES, select=f"""SELECT symbol, count(*) AS record_count,
  round(avg(avg_price), 8) AS overall_avg_price, sum(total_volume)::BIGINT AS total_volume_all_time
  FROM daily WHERE date >= {X.LAST_TRADE_DAY} - 90 GROUP BY symbol"""))
def rollup_90d(spark, sf_dir):
    return plain(A.long_rollup(X.daily_trades(spark, sf_dir), X.last_trade_day(spark, sf_dir)), "overall_avg_price")


NAMED_SQL = """SELECT d.symbol, count(*) AS days, round(avg(d.avg_price), 8) AS avg_daily_price,
  max(p.newest) AS newest, min(p.ticks) AS ticks
  FROM daily_aggregates d JOIN (
    SELECT symbol, max(timestamp) AS newest, count(*) AS ticks FROM stock_prices GROUP BY symbol) p
    ON p.symbol = d.symbol GROUP BY d.symbol"""


@query(with_ctes(DAILY_CORE, "daily_aggregates AS (FROM daily)",
                 "stock_prices AS (SELECT *, event_timestamp AS timestamp FROM quotes)", select=NAMED_SQL))
def named_table_sql(spark, sf_dir):
    """SQL text over tables by name."""
    register_views(spark, {
        "stock_prices": X.quotes(spark, sf_dir).withColumnRenamed("event_timestamp", "timestamp"),
        "daily_aggregates": X.daily_core(spark, sf_dir)})
    return spark.sql(NAMED_SQL)


@query(with_ctes(DAILY, select=f"""SELECT count(*) AS symbols, count(*) FILTER (avg_price_change > 0) AS gainers,
  count(*) FILTER (avg_price_change < 0) AS losers, sum(total_volume)::BIGINT AS total_volume,
  round(avg(avg_price_change_pct), 8) AS avg_change_pct FROM daily WHERE date = {LAST_DAY}"""))
def market_summary(spark, sf_dir):
    today = X.last_day(spark, sf_dir)
    return plain(A.market_summary(X.daily(spark, sf_dir, today, today), today), "avg_change_pct")
