"""Queries over two versions of a table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.operators.history import Moment, compare


def current_vs_historical(rows: DataFrame, moment: Moment, day: str | date,
                          keys: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """A day's average prices now and as the table stood at ``moment``, in one pass over rows
    that carry their commit times; the day is a filter on files."""
    of_day = rows.filter(F.col("date") == F.lit(day).cast("date"))
    return compare(of_day, moment, None, keys, "avg_price").select(
        "symbol", F.col("avg_price_v2").alias("current_price"), F.col("avg_price_v1").alias("historical_price"),
        F.col("avg_price_change").alias("price_change"))
