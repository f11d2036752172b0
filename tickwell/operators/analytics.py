"""The analytical query corpus over daily aggregates and raw ticks.

``as_of`` stands for the current date. Trailing ranges include both ends, so N
days back covers N + 1 calendar days. Filters are plain comparisons on ``date``
and ``symbol``, which Spark turns into partition and Parquet filters.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Day = str | date | None


def _today(as_of: Day) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def on_day(df: DataFrame, as_of: Day = None) -> DataFrame:
    return df.filter(F.col("date") == _today(as_of))


def trailing(df: DataFrame, days: int, as_of: Day = None) -> DataFrame:
    return df.filter(F.col("date") >= F.date_sub(_today(as_of), days))


# Raw prices ---------------------------------------------------------------

def latest_prices(prices: DataFrame, as_of: Day = None, n: int = 100, symbol: str | None = None,
                  order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """The day's newest ticks, optionally of one symbol, newest first. Of equal times, the other
    columns decide, in order, so the rows at the limit are determined."""
    rows = on_day(prices, as_of)
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol)
    rest = [c for c in rows.columns if c not in order]
    return rows.orderBy(*[F.col(c).desc() for c in order], *rest).limit(n)


def intraday_summary(prices: DataFrame, as_of: Day = None) -> DataFrame:
    return on_day(prices, as_of).groupBy("symbol").agg(
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"))


def avg_raw_price(prices: DataFrame, as_of: Day = None, days: int = 7) -> DataFrame:
    return trailing(prices, days, as_of).groupBy("symbol").agg(F.avg("price").alias("avg_price"))


# Daily rows ---------------------------------------------------------------

def daily_for_symbol(daily: DataFrame, symbol: str, n: int = 30) -> DataFrame:
    return (daily.filter(F.col("symbol") == symbol)
            .select("symbol", "date", "avg_price", "max_price", "min_price", "total_volume",
                    "price_range", "price_range_pct")
            .orderBy(F.col("date").desc()).limit(n))


def daily_today(daily: DataFrame, as_of: Day = None) -> DataFrame:
    return on_day(daily, as_of)


def daily_summary(daily: DataFrame, as_of: Day = None, days: int = 7) -> DataFrame:
    return (trailing(daily, days, as_of)
            .select("symbol", "date", "avg_price", "max_price", "min_price", "total_volume",
                    "price_range_pct")
            .orderBy(F.col("date").desc(), "symbol"))


def symbol_days(daily: DataFrame, symbol: str, as_of: Day = None, days: int = 7) -> DataFrame:
    """One symbol, a few days: on a table partitioned by symbol and date both
    conditions are partition filters."""
    return (trailing(daily, days, as_of).filter(F.col("symbol") == symbol)
            .select("symbol", "date", "avg_price", "total_volume")
            .orderBy(F.col("date").desc()))


def price_trend(daily: DataFrame, symbol: str, as_of: Day = None, days: int = 30) -> DataFrame:
    return (trailing(daily, days, as_of).filter(F.col("symbol") == symbol)
            .select("date", "avg_price", "max_price", "min_price", "price_range", "total_volume")
            .orderBy("date"))


def avg_price_rollup(daily: DataFrame, as_of: Day = None, days: int = 7) -> DataFrame:
    return (trailing(daily, days, as_of).groupBy("symbol").agg(
        F.avg("avg_price").alias("avg_daily_price"),
        F.max("max_price").alias("max_price_7d"),
        F.min("min_price").alias("min_price_7d"),
        F.sum("total_volume").alias("total_volume_7d"))
        .orderBy(F.col("avg_daily_price").desc(), "symbol"))


def top_volume_today(daily: DataFrame, as_of: Day = None, n: int = 5) -> DataFrame:
    return (on_day(daily, as_of).groupBy("symbol").agg(F.sum("total_volume").alias("total_volume"))
            .orderBy(F.col("total_volume").desc(), "symbol").limit(n))


def top_volume(daily: DataFrame, as_of: Day = None, days: int = 7, n: int = 10) -> DataFrame:
    return (trailing(daily, days, as_of).groupBy("symbol")
            .agg(F.sum("total_volume").alias("total_volume_7d"))
            .orderBy(F.col("total_volume_7d").desc(), "symbol").limit(n))


def moving_average(daily: DataFrame, as_of: Day = None, days: int = 30, rows: int = 7,
                   symbol: str | None = None) -> DataFrame:
    """Average over the last ``rows`` daily rows of each symbol.

    The trailing filter comes first: the window never looks back beyond it, and a
    symbol has at most ``days + 1`` rows in its window partition.
    """
    recent = trailing(daily, days, as_of)
    if symbol is not None:
        recent = recent.filter(F.col("symbol") == symbol)
    frame = Window.partitionBy("symbol").orderBy("date").rowsBetween(1 - rows, 0)
    return (recent.select("symbol", "date", "avg_price",
                          F.avg("avg_price").over(frame).alias("moving_avg_7d"))
            .orderBy("symbol", "date"))


def volatility(daily: DataFrame, as_of: Day = None, days: int = 30) -> DataFrame:
    pct = "avg_price_change_pct"
    return (trailing(daily, days, as_of).groupBy("symbol").agg(
        F.avg(pct).alias("avg_daily_change_pct"),
        F.stddev_samp(pct).alias("volatility"),
        F.max(pct).alias("max_daily_change_pct"),
        F.min(pct).alias("min_daily_change_pct"))
        .orderBy(F.col("volatility").desc(), "symbol"))


def symbol_correlation(daily: DataFrame, first: str, second: str, as_of: Day = None,
                       days: int = 30) -> DataFrame:
    """Correlation of two symbols' daily prices over the dates both have.

    Both symbols are read in one pass and aligned by date with conditional
    aggregates, in place of two reads and a join; a symbol has one row per date.
    """
    def of(symbol: str) -> Column:
        return F.max(F.when(F.col("symbol") == symbol, F.col("avg_price")))

    pairs = (trailing(daily, days, as_of).filter(F.col("symbol").isin(first, second))
             .groupBy("date").agg(of(first).alias("a"), of(second).alias("b"))
             .filter(F.col("a").isNotNull() & F.col("b").isNotNull()))
    return pairs.agg(F.corr("a", "b").alias("price_correlation"))


def volume_distribution(daily: DataFrame, as_of: Day = None, days: int = 30) -> DataFrame:
    """Day count, mean, extremes and exact interpolated median of daily volume."""
    return (trailing(daily, days, as_of).groupBy("symbol").agg(
        F.count("*").alias("trading_days"),
        F.avg("total_volume").alias("avg_daily_volume"),
        F.max("total_volume").alias("max_daily_volume"),
        F.min("total_volume").alias("min_daily_volume"),
        F.median("total_volume").alias("median_volume"))
        .orderBy(F.col("avg_daily_volume").desc(), "symbol"))


def unusual_volume_days(daily: DataFrame, as_of: Day = None, stats_days: int | None = 30,
                        recent_days: int | None = 7, factor: float = 2.0) -> DataFrame:
    """Recent days whose volume exceeds ``factor`` times the symbol's mean.

    The mean over ``stats_days`` comes from a window over the symbol's daily rows,
    so the daily table is computed and shuffled once rather than joined back to
    itself. ``None`` means the whole history.
    """
    today = _today(as_of)

    def within(days: int | None) -> Column:
        return F.lit(True) if days is None else F.col("date") >= F.date_sub(today, days)

    symbol = Window.partitionBy("symbol")
    in_stats = F.when(within(stats_days), F.col("total_volume"))
    rows = daily.filter(within(stats_days) | within(recent_days))
    return (rows.select("date", "symbol", "total_volume",
                        F.avg(in_stats).over(symbol).alias("avg_volume"),
                        F.stddev_samp(in_stats).over(symbol).alias("stddev_volume"))
            .filter(within(recent_days) & (F.col("total_volume") > F.col("avg_volume") * factor))
            .withColumn("volume_multiplier", F.try_divide(F.col("total_volume"), F.col("avg_volume")))
            .select("date", "symbol", "total_volume", "avg_volume", "stddev_volume", "volume_multiplier")
            .orderBy(F.col("volume_multiplier").desc(), "symbol", "date"))


def long_rollup(daily: DataFrame, as_of: Day = None, days: int = 90) -> DataFrame:
    return (trailing(daily, days, as_of).groupBy("symbol").agg(
        F.count("*").alias("record_count"),
        F.avg("avg_price").alias("overall_avg_price"),
        F.sum("total_volume").alias("total_volume_all_time"))
        .orderBy(F.col("total_volume_all_time").desc(), "symbol"))


def market_summary(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """One row over all symbols of the day."""
    change = F.col("avg_price_change")
    return on_day(daily, as_of).agg(
        F.count("*").alias("symbols"),
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change < 0).alias("losers"),
        F.sum("total_volume").alias("total_volume"),
        F.avg("avg_price_change_pct").alias("avg_change_pct"))
