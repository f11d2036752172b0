"""Aggregates of raw ticks: per symbol and day, per event-time window, latest per symbol.

All are plain hash aggregations. Spark combines rows on the map side before the
shuffle, so a symbol that holds a large part of all ticks costs one partial row
per task and group, not one task with all of its ticks.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.operators.lookup import settled


def _day_column(df: DataFrame, day: str | date | None) -> Column:
    """Event time if present, else the message time, else the given day."""
    if "event_timestamp" in df.columns:
        return F.to_date("event_timestamp")
    if "timestamp" in df.columns:
        return F.to_date(F.col("timestamp"))
    return F.lit(day).cast("date")


# Output columns of the aggregates, in order.
PRICE_MEASURES = ("avg_price", "max_price", "min_price", "max_high", "min_low", "total_volume", "record_count")
VOLUME_MEASURES = ("total_volume", "avg_volume", "max_volume", "avg_price", "record_count")
DAILY_PRICE_MEASURES = (*PRICE_MEASURES, "avg_price_change", "avg_price_change_pct")
DAILY_VOLUME_MEASURES = ("total_volume", "avg_volume", "max_volume", "min_volume", "avg_price", "record_count")

# Daily price measures that need no more than price and volume of a tick.
CORE_MEASURES = ("avg_price", "max_price", "min_price", "total_volume", "record_count")


def _measures(names: tuple[str, ...]) -> list[Column]:
    measures = {
        "avg_price": F.avg("price").alias("avg_price"),
        "max_price": F.max("price").alias("max_price"),
        "min_price": F.min("price").alias("min_price"),
        "max_high": F.max("high").alias("max_high"),
        "min_low": F.min("low").alias("min_low"),
        "total_volume": F.sum("volume").alias("total_volume"),
        "avg_volume": F.avg("volume").alias("avg_volume"),
        "max_volume": F.max("volume").alias("max_volume"),
        "min_volume": F.min("volume").alias("min_volume"),
        "avg_price_change": F.avg("price_change").alias("avg_price_change"),
        "avg_price_change_pct": F.avg("price_change_pct").alias("avg_price_change_pct"),
        "record_count": F.count("*").alias("record_count"),
    }
    return [measures[name] for name in names]


def daily_prices(df: DataFrame, day: str | date | None = None,
                 measures: tuple[str, ...] = DAILY_PRICE_MEASURES) -> DataFrame:
    """Daily price aggregate by symbol and date, with the day's price range.

    ``measures`` narrows the output (the range needs avg, max and min price); with
    it, columns such as ``high`` or ``price_change`` need not exist in ``df``.
    """
    spread = F.col("max_price") - F.col("min_price")
    return (df.groupBy("symbol", _day_column(df, day).alias("date")).agg(*_measures(measures))
            .withColumns({
                "price_range": spread,
                "price_range_pct": F.try_divide(spread, F.col("avg_price")) * 100,
            }))


def daily_volumes(df: DataFrame, day: str | date | None = None) -> DataFrame:
    return (df.groupBy("symbol", _day_column(df, day).alias("date"))
            .agg(*_measures(DAILY_VOLUME_MEASURES)))


def _by_window(df: DataFrame, duration: str, slide: str | None, measures: tuple[str, ...]) -> DataFrame:
    window = F.window("event_timestamp", duration, slide)
    return df.groupBy("symbol", window).agg(*_measures(measures)).select(
        "symbol", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *measures)


def window_prices(df: DataFrame, duration: str = "1 minute",
                  slide: str | None = "30 seconds") -> DataFrame:
    """Prices per symbol and event-time window; ``slide=None`` gives tumbling windows."""
    return _by_window(df, duration, slide, PRICE_MEASURES)


def window_volumes(df: DataFrame, duration: str = "1 minute",
                   slide: str | None = "30 seconds") -> DataFrame:
    return _by_window(df, duration, slide, VOLUME_MEASURES)


def latest_per_symbol(df: DataFrame, order: tuple[str, ...] = ("event_timestamp", "tick_id")) -> DataFrame:
    """The newest row of each symbol, all columns. ``df`` is read twice.

    The newest time per symbol is a hash aggregate over two columns; only rows of that
    time then compete as whole rows. Comparing whole rows from the start would sort
    all ticks by symbol. Copies of the newest row are combined on the map side.
    """
    time, rest = order[0], [c for c in df.columns if c != "symbol"]
    newest = settled(df.groupBy(F.col("symbol").alias("_symbol")).agg(F.max(time).alias("_newest")))
    rivals = df.join(newest, F.col("symbol").eqNullSafe(F.col("_symbol"))
                     & F.col(time).eqNullSafe(F.col("_newest")))
    first = F.max_by(F.struct(*rest), F.struct(*order))
    return rivals.groupBy("symbol").agg(first.alias("row")).select("symbol", "row.*")
