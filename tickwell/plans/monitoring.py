"""Alert rules over the event flow.

The reference thresholds suit a feed of a few messages per second; here they are
also run with values that split the given data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.operators import monitoring as M
from tickwell.plans import frames as X
from tickwell.plans.frames import QUOTES, plain, with_ctes
from tickwell.plans.registry import query


def episodes_sql(series: str, breached: str, seconds: int, for_seconds: int, alert: str, severity: str) -> str:
    """``series`` defines CTE ``series(bucket, value)``; runs by row-number difference."""
    return with_ctes(QUOTES, series, f"""runs AS (
  SELECT min(bucket) AS bucket, count(*) AS windows, min(value) AS min_value, max(value) AS max_value
  FROM (SELECT *, bucket - row_number() OVER (ORDER BY bucket) AS run FROM series WHERE {breached})
  GROUP BY run)""", select=f"""SELECT '{alert}' AS alert, '{severity}' AS severity,
  make_timestamp(bucket * {seconds} * 1000000) AS breached_from,
  make_timestamp((bucket * {seconds} + {for_seconds}) * 1000000) AS firing_from,
  make_timestamp((bucket + windows) * {seconds} * 1000000) AS resolved_at,
  windows, min_value, max_value FROM runs WHERE windows * {seconds} >= {for_seconds}""")


def rate_sql(seconds: int, counted: str = "TRUE") -> str:
    return f"""found AS (SELECT floor(epoch(event_timestamp) / {seconds})::BIGINT AS bucket,
    count(*) FILTER ({counted}) AS n FROM quotes GROUP BY 1),
series AS (SELECT b.bucket, coalesce(n, 0) / {seconds} AS value FROM (
    SELECT unnest(range((SELECT min(bucket) FROM found), (SELECT max(bucket) FROM found) + 1)) AS bucket) b
    LEFT JOIN found USING (bucket))"""


@query(episodes_sql(rate_sql(300), "value < 0.1", 300, 600, "LowDataIngestionRate", "warning"))
def alert_low_ingestion(spark, sf_dir):
    return plain(M.low_ingestion(X.quotes(spark, sf_dir)))


@query(episodes_sql(rate_sql(300), "value < 0.002", 300, 600, "LowDataIngestionRate", "warning"))
def alert_low_ingestion_silence(spark, sf_dir):
    """At most one message per five minutes at the smaller scales."""
    return plain(M.low_ingestion(X.quotes(spark, sf_dir), threshold=0.002))


@query(episodes_sql(rate_sql(300, "symbol = 'error'"), "value > 0.1", 300, 300, "HighErrorRate", "critical"))
def alert_error_rate(spark, sf_dir):
    return plain(M.high_error_rate(X.quotes(spark, sf_dir), F.col("symbol") == "error"))


@query(episodes_sql(rate_sql(3600, "symbol = 'error'"), "value > 0.0008", 3600, 7200, "HighErrorRate", "critical"))
def alert_error_rate_hourly(spark, sf_dir):
    return plain(M.high_error_rate(X.quotes(spark, sf_dir), F.col("symbol") == "error", threshold=0.0008,
                                   window_seconds=3600, for_seconds=7200))


@query(episodes_sql(rate_sql(3600, "symbol = 'error'"), "value > 0.0001", 3600, 3600, "HighErrorRate", "critical"))
def alert_error_rate_fires(spark, sf_dir):
    """A threshold that the given data does exceed at every scale."""
    return plain(M.high_error_rate(X.quotes(spark, sf_dir), F.col("symbol") == "error", threshold=0.0001,
                                   window_seconds=3600, for_seconds=3600))


OUTAGE = """found AS (SELECT floor(epoch(event_timestamp) / 300)::BIGINT AS bucket, count(*) AS n FROM quotes GROUP BY 1),
series AS (SELECT b.bucket, coalesce(n, 0) / 300 AS value FROM (
    SELECT unnest(range((epoch(TIMESTAMP '2023-12-31 22:00:00') / 300)::BIGINT,
                        (epoch(TIMESTAMP '2024-02-01 03:00:00') / 300)::BIGINT)) AS bucket) b
    LEFT JOIN found USING (bucket))"""


@query(episodes_sql(OUTAGE, "value < 0.002", 300, 600, "LowDataIngestionRate", "warning"))
def alert_outage_until_now(spark, sf_dir):
    """Looked at some time after the last message and from before the first: both silences count."""
    return plain(M.low_ingestion(X.quotes(spark, sf_dir), threshold=0.002, start="2023-12-31 22:00:00",
                                 until="2024-02-01 03:00:00"))


# A message with k in its payload counts as consumed k minutes after it was produced.
LAG = """produced AS (SELECT floor(epoch(event_timestamp) / 300)::BIGINT AS bucket FROM quotes),
consumed AS (SELECT floor((epoch(event_timestamp) + volume * 60) / 300)::BIGINT AS bucket FROM quotes),
deltas AS (SELECT bucket, sum(d) AS d FROM (
    SELECT bucket, 1 AS d FROM produced UNION ALL SELECT bucket, -1 FROM consumed) GROUP BY bucket),
series AS (SELECT b.bucket, (sum(coalesce(d, 0)) OVER (ORDER BY b.bucket))::BIGINT AS value FROM (
    SELECT unnest(range((SELECT min(bucket) FROM deltas), (SELECT max(bucket) FROM deltas) + 1)) AS bucket) b
    LEFT JOIN deltas USING (bucket))"""


def _consumed(spark, sf_dir):
    later = F.make_dt_interval(mins=F.col("volume").cast("int"))
    return X.quotes(spark, sf_dir).select((F.col("event_timestamp") + later).alias("event_timestamp"))


@query(episodes_sql(LAG, "value > 12", 300, 300, "HighKafkaLag", "warning"))
def alert_consumer_lag(spark, sf_dir):
    return plain(M.high_lag(X.quotes(spark, sf_dir), _consumed(spark, sf_dir), threshold=12))


@query(with_ctes(QUOTES, LAG, select="SELECT make_timestamp((bucket + 1) * 300 * 1000000) AS window_end, value AS lag FROM series"))
def consumer_lag_series(spark, sf_dir):
    lag = M.consumer_lag(X.quotes(spark, sf_dir), _consumed(spark, sf_dir))
    return plain(lag.select(F.timestamp_seconds((F.col("bucket") + 1) * 300).alias("window_end"),
                            F.col("value").alias("lag")))
