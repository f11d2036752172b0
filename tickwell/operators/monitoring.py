"""Data-flow alert rules as event-time queries.

A rule looks at a rate per tumbling window, empty windows included, and fires once
the condition has held for enough consecutive windows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.operators.running import running_total
from tickwell.session import cut

Moment = str | datetime | None


def _bucket(seconds: int, time: str = "event_timestamp") -> Column:
    """Number of the window a time falls in, counted from the epoch."""
    return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds).cast("bigint")


def _bucket_of(moment: Moment, seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.lit(moment).cast("timestamp")) / seconds).cast("bigint")


# Buckets that meet in one task when neighbours are looked up.
_BLOCK = 4096


def _stretches(found: DataFrame, empty: Column, start: Column | None, until: Column | None) -> DataFrame:
    """``bucket, windows, value`` without overlap: each found window, and the windows
    between two found ones as one stretch with the value ``empty``.

    ``start`` and ``until`` (window numbers, the second excluded) add the silence before
    the first and after the last found window. There is no row for each empty window, so a
    wrong clock costs one stretch. ``found`` is read twice: cut it before.
    """
    rows = found.select("bucket", "value", F.lit(True).alias("real"))
    edges = [(start - 1) if start is not None else None, until]
    for edge in (e for e in edges if e is not None):
        rows = rows.unionByName(found.sparkSession.range(1).select(
            edge.alias("bucket"), F.lit(None).cast("double").alias("value"), F.lit(False).alias("real")))
    if start is not None:
        rows = rows.where(F.col("bucket") >= start - 1)
    if until is not None:
        rows = rows.where((F.col("bucket") < until) | (~F.col("real") & (F.col("bucket") == until)))
    rows = rows.withColumn("block", F.floor(F.col("bucket") / _BLOCK))
    # the next window is in the same block, or is the first of the next block that has any
    firsts = rows.groupBy("block").agg(F.min("bucket").alias("first"))
    after = firsts.select("block", F.lead("first").over(Window.orderBy("block")).alias("next_block"))
    inside = Window.partitionBy("block").orderBy("bucket")
    rows = rows.withColumn("next", F.lead("bucket").over(inside)).join(after, "block").withColumn(
        "next", F.coalesce("next", "next_block"))
    own = F.when(F.col("real"), F.struct("bucket", F.lit(1).cast("bigint").alias("windows"), "value"))
    gap = F.when(F.col("next") > F.col("bucket") + 1, F.struct(
        (F.col("bucket") + 1).alias("bucket"), (F.col("next") - F.col("bucket") - 1).alias("windows"), empty.alias("value")))
    return rows.select(F.explode(F.filter(F.array(own, gap), lambda x: x.isNotNull())).alias("s")).select("s.*")


def _rates(events: DataFrame, seconds: int, counted: Column | None, start: Moment, until: Moment) -> DataFrame:
    """Rows per second of each window (``counted`` narrows which), as stretches."""
    wanted = F.count("*") if counted is None else F.count_if(counted)
    found = events.groupBy(_bucket(seconds).alias("bucket")).agg((wanted / seconds).alias("value"))
    return _stretches(cut(found.where("bucket is not null")), F.lit(0.0),
                      None if start is None else _bucket_of(start, seconds),
                      None if until is None else _bucket_of(until, seconds))


def episodes(series: DataFrame, breached: Column, seconds: int, for_seconds: int, alert: str,
             severity: str) -> DataFrame:
    """Maximal runs of breached windows at least ``for_seconds`` long.

    ``series`` has rows ``bucket, windows, value`` that follow each other without holes;
    without ``windows``, each row is one window.
    Every stretch that is not breached ends a run, so the running count of those numbers the
    runs; the count is taken slice-wise and needs no single-task pass over the time line.
    """
    if "windows" not in series.columns:
        series = series.withColumn("windows", F.lit(1).cast("bigint"))
    marked = series.select("bucket", "windows", "value", (~breached).cast("bigint").alias("calm"))
    numbered = running_total(marked, [], ["bucket"], "calm", "run", large=False)
    runs = (numbered.filter(F.col("calm") == 0).groupBy("run").agg(
        F.min("bucket").alias("bucket"), F.sum("windows").alias("windows"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value")))
    start = F.col("bucket") * seconds
    return (runs.filter(F.col("windows") * seconds >= for_seconds)
            .select(F.lit(alert).alias("alert"), F.lit(severity).alias("severity"),
                    F.timestamp_seconds(start).alias("breached_from"),
                    F.timestamp_seconds(start + for_seconds).alias("firing_from"),
                    F.timestamp_seconds(start + F.col("windows") * seconds).alias("resolved_at"),
                    "windows", "min_value", "max_value"))


def low_ingestion(events: DataFrame, threshold: float = 0.1, window_seconds: int = 300,
                  for_seconds: int = 600, start: Moment = None, until: Moment = None) -> DataFrame:
    """Fewer than ``threshold`` messages per second, sustained.

    With ``until``, usually now, silence after the last message counts up to the last whole
    window before it: an outage that goes on is found. ``start`` does so before the first.
    """
    rate = _rates(events, window_seconds, None, start, until)
    return episodes(rate, F.col("value") < threshold, window_seconds, for_seconds,
                    "LowDataIngestionRate", "warning")


def high_error_rate(events: DataFrame, is_error: Column, threshold: float = 0.1,
                    window_seconds: int = 300, for_seconds: int = 300, start: Moment = None,
                    until: Moment = None) -> DataFrame:
    """More than ``threshold`` errors per second, sustained."""
    rate = _rates(events, window_seconds, is_error, start, until)
    return episodes(rate, F.col("value") > threshold, window_seconds, for_seconds,
                    "HighErrorRate", "critical")


def _lag(produced: DataFrame, consumed: DataFrame, window_seconds: int) -> DataFrame:
    """Messages produced and not yet consumed at the end of every window with any change."""
    deltas = (produced.select(_bucket(window_seconds).alias("bucket"), F.lit(1).alias("d"))
              .unionAll(consumed.select(_bucket(window_seconds).alias("bucket"), F.lit(-1).alias("d")))
              .groupBy("bucket").agg(F.sum("d").alias("d")).where("bucket is not null"))
    return running_total(deltas, [], ["bucket"], "d", "value", large=False).select("bucket", "value")


def consumer_lag(produced: DataFrame, consumed: DataFrame, window_seconds: int = 300) -> DataFrame:
    """Lag at the end of every window from the first to the last change. Where a whole row
    for each window is wanted, its number is that of the windows; the alert rule goes without."""
    between = _stretches(cut(_lag(produced, consumed, window_seconds)), F.col("value"), None, None)
    # in steps, so that no single row carries a long array
    step = F.lit(1000).cast("bigint")
    last = F.col("bucket") + F.col("windows") - 1
    blocks = between.select("value", last.alias("last"), F.explode(F.sequence("bucket", last, step)).alias("block"))
    return blocks.repartition("block").select(
        F.explode(F.sequence("block", F.least(F.col("block") + step - 1, "last"))).alias("bucket"), "value")


def high_lag(produced: DataFrame, consumed: DataFrame, threshold: int = 10_000,
             window_seconds: int = 300, for_seconds: int = 300, until: Moment = None) -> DataFrame:
    """More than ``threshold`` messages behind, sustained. With ``until``, the lag after the
    last change lasts up to it."""
    lag = _stretches(cut(_lag(produced, consumed, window_seconds)), F.col("value"), None,
                     None if until is None else _bucket_of(until, window_seconds))
    return episodes(lag, F.col("value") > threshold,
                    window_seconds, for_seconds, "HighKafkaLag", "warning")
