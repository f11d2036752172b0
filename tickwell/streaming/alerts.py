"""Alert rules as running queries: an alert fires when its condition has held long enough, and resolves
when it has stopped to hold.

Messages are counted by window as they come. So that silence is seen too, a stream of heartbeats
takes part: a beat counts as no message, but it moves the watermark and gives empty windows a row. Closed
windows, one row each, go to a processor with a few numbers of state for each rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENTS = ("alert string, severity string, state string, at timestamp, breached_from timestamp, windows long, "
          "min_value double, max_value double")
_RUN = "next long, began long, windows long, low double, high double, fired boolean"


def heartbeats(spark: SparkSession, seconds: int = 60) -> DataFrame:
    """A beat every ``seconds`` by the clock."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return beats.where(F.unix_seconds("timestamp") % seconds == 0).select(F.col("timestamp").alias("event_timestamp"))


def closed_windows(messages: DataFrame, beats: DataFrame, seconds: int, delay: str) -> DataFrame:
    """window_at, bucket and messages a second of every window that messages or beats fall in, once closed."""
    both = messages.select("event_timestamp", F.lit(1).alias("counted")).unionByName(
        beats.select("event_timestamp", F.lit(0).alias("counted")))
    rates = both.withWatermark("event_timestamp", delay).groupBy(F.window("event_timestamp", f"{seconds} seconds")).agg(
        (F.sum("counted") / seconds).alias("value"))
    return rates.select(F.window_time("window").alias("window_at"),
                        (F.unix_seconds(F.col("window.start")) / seconds).cast("long").alias("bucket"), "value")


class SustainedRule(StatefulProcessor):
    """Follows closed windows in order and reports when a run of breached ones is long enough and when it
    ends. Windows that are missing altogether count as empty."""

    def __init__(self, alert: str, severity: str, below: float | None, above: float | None, seconds: int, for_seconds: int):
        self.alert, self.severity, self.below, self.above = alert, severity, below, above
        self.seconds, self.needed = seconds, -(-for_seconds // seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", _RUN)

    def _breached(self, value: float) -> bool:
        return (self.below is not None and value < self.below) or (self.above is not None and value > self.above)

    def _event(self, state: str, bucket: int, began: int, windows: int, low: float, high: float) -> tuple:
        at, since = (datetime.fromtimestamp(b * self.seconds, timezone.utc).replace(tzinfo=None) for b in (bucket, began))
        return self.alert, self.severity, state, pd.Timestamp(at), pd.Timestamp(since), windows, low, high

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(list(rows)).sort_values("bucket")
        following, began, count, low, high, fired = self.run.get() if self.run.exists() else (None, -1, 0, 0.0, 0.0, False)
        out = []
        for bucket, value in zip(windows["bucket"].tolist(), windows["value"].tolist()):
            stretches = [(bucket, 1, value)]
            if following is not None and bucket > following:
                stretches.insert(0, (following, bucket - following, 0.0))
            for first, length, rate in stretches:
                if self._breached(rate):
                    low, high = (min(low, rate), max(high, rate)) if count else (rate, rate)
                    began, count = (began, count + length) if count else (first, length)
                    if not fired and count >= self.needed:
                        fired = True
                        out.append(self._event("firing", began + self.needed, began, count, low, high))
                else:
                    if fired:
                        out.append(self._event("resolved", first, began, count, low, high))
                    began, count, fired = -1, 0, False
            following = bucket + 1
        self.run.update((following, began, count, low, high, fired))
        yield pd.DataFrame(out, columns=["alert", "severity", "state", "at", "breached_from", "windows", "min_value", "max_value"])

    def close(self) -> None:
        pass


def _followed(windows: DataFrame, rule: SustainedRule) -> DataFrame:
    # one row for each window of the whole flow: a single key of little work
    return windows.withColumn("alert", F.lit(rule.alert)).groupBy("alert").transformWithStateInPandas(
        statefulProcessor=rule, outputStructType=EVENTS, outputMode="Append", timeMode="EventTime")


def low_ingestion(messages: DataFrame, beats: DataFrame, threshold: float = 0.1, window_seconds: int = 300,
                  for_seconds: int = 600, delay: str = "1 minute") -> DataFrame:
    """Fewer than ``threshold`` messages per second, sustained. Fires in silence as well."""
    return _followed(closed_windows(messages, beats, window_seconds, delay),
                     SustainedRule("LowDataIngestionRate", "warning", threshold, None, window_seconds, for_seconds))


def high_error_rate(errors: DataFrame, beats: DataFrame, threshold: float = 0.1, window_seconds: int = 300,
                    for_seconds: int = 300, delay: str = "1 minute") -> DataFrame:
    """More than ``threshold`` errors per second, sustained."""
    return _followed(closed_windows(errors, beats, window_seconds, delay),
                     SustainedRule("HighErrorRate", "critical", None, threshold, window_seconds, for_seconds))
