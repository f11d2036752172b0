"""Streams run to the end of the given data into fresh folders, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.plans import frames as X
from tickwell.plans.analytics import (PER_WINDOW, WINDOW_PRICES_OUT, WINDOW_VOLUMES_OUT, windows_sql)
from tickwell.plans.frames import DIRTY, ISO, QUOTES, STORED_PRICES, STORED_VOLUMES, TICKS, plain, with_ctes
from tickwell.plans.quality import JUDGED, PARSED
from tickwell.plans.registry import query
from tickwell.plans.storage import price_topic, volume_topic
from tickwell.schemas import RAW_PARTITIONS, RAW_PRICES, RAW_VOLUMES, REJECTS, VOLUME_MESSAGE
from tickwell.session import fresh_dir, stream_session
from tickwell.sources.messages import publish_messages, stream_messages
from tickwell.streaming import pipelines as P
from tickwell.streaming.progress import progress_frame

TO_END = P.StreamSettings(trigger=None)
BY_DAY = ("year", "month", "day")


def _dirs(spark, label):
    root = fresh_dir(spark, label)
    return f"{root}/out", f"{root}/checkpoint"


# Raw streams --------------------------------------------------------------

@query(with_ctes(TICKS, STORED_PRICES, select=f"""SELECT symbol AS kafka_key, CAST(tick_id % 2 AS INT) AS kafka_partition,
  tick_id AS kafka_offset, event_timestamp AS kafka_timestamp, symbol, {ISO} AS timestamp, price, open, high, low,
  volume, previous_close, market_cap, currency, event_timestamp, price_change,
  round(price_change_pct, 8) AS price_change_pct, year(event_timestamp)::INT AS year,
  month(event_timestamp)::INT AS month, day(event_timestamp)::INT AS day, hour(event_timestamp)::INT AS hour
  FROM stored"""))
def stream_raw_prices(spark, sf_dir):
    """The full partition layout: year, month, day, hour and symbol."""
    out, checkpoint = _dirs(spark, "stream-prices")
    raw = P.raw_prices(stream_messages(spark, price_topic(spark, sf_dir)))
    P.run_to_end(P.gathered(raw, RAW_PARTITIONS), out, checkpoint, RAW_PARTITIONS)
    stored = spark.read.schema(RAW_PRICES).parquet(out).drop("processing_timestamp")
    return plain(stored, "price_change_pct")


@query(with_ctes(QUOTES, STORED_VOLUMES, select=f"""SELECT symbol AS kafka_key, CAST(tick_id % 2 AS INT) AS kafka_partition,
  tick_id AS kafka_offset, event_timestamp AS kafka_timestamp, symbol, {ISO} AS timestamp, volume, price,
  event_timestamp, year(event_timestamp)::INT AS year, month(event_timestamp)::INT AS month,
  day(event_timestamp)::INT AS day, hour(event_timestamp)::INT AS hour FROM stored"""))
def stream_raw_volumes(spark, sf_dir):
    out, checkpoint = _dirs(spark, "stream-volumes")
    P.run_to_end(P.raw_volumes(stream_messages(spark, volume_topic(spark, sf_dir))), out, checkpoint, BY_DAY)
    return plain(spark.read.schema(RAW_VOLUMES).parquet(out).drop("processing_timestamp"))


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT target, symbol, count(*) AS rows, sum(volume)::BIGINT AS volume
  FROM stored CROSS JOIN (VALUES ('first'), ('second')) t(target) GROUP BY ALL"""))
def stream_fanout(spark, sf_dir):
    out, checkpoint = _dirs(spark, "stream-fanout")
    paths = {"first": f"{out}/first", "second": f"{out}/second"}
    raw = P.raw_volumes(stream_messages(spark, volume_topic(spark, sf_dir)))
    P.start_fan_out(raw, list(paths.values()), checkpoint, TO_END, BY_DAY).awaitTermination()
    first, second = (spark.read.schema(RAW_VOLUMES).parquet(path).select(F.lit(target).alias("target"), "symbol", "volume")
                     for target, path in paths.items())
    return first.unionAll(second).groupBy("target", "symbol").agg(
        F.count("*").alias("rows"), F.sum("volume").alias("volume"))


@query(with_ctes(DIRTY, PARSED, JUDGED, select="""SELECT kafka_partition, kafka_offset, bad AS reason,
  year(kafka_timestamp)::INT AS year, month(kafka_timestamp)::INT AS month, day(kafka_timestamp)::INT AS day
  FROM judged WHERE bad IS NOT NULL"""))
def stream_rejects(spark, sf_dir):
    """Messages that become no tick: stored with the reason, by the day they came in."""
    topic = fresh_dir(spark, "dirty-topic")
    publish_messages(X.dirty_messages(spark, sf_dir), topic)
    out, checkpoint = _dirs(spark, "stream-rejects")
    P.run_to_end(P.rejected(stream_messages(spark, topic)), out, checkpoint, BY_DAY)
    stored = spark.read.schema(REJECTS).parquet(out)
    return stored.select("kafka_partition", "kafka_offset", "reason", "year", "month", "day")


# Windowed streams ---------------------------------------------------------
# Append mode has written every window that ended by the final watermark.

CLOSED = " WHERE window_end <= (SELECT max(event_timestamp) FROM stored) - INTERVAL 1 MINUTE"


@query(with_ctes(TICKS, STORED_PRICES, windows_sql(60, 30, "stored"), select=WINDOW_PRICES_OUT + CLOSED + PER_WINDOW))
def stream_window_prices(spark, sf_dir):
    own = stream_session(spark)
    out, checkpoint = _dirs(spark, "stream-window-prices")
    raw = P.raw_prices(stream_messages(own, price_topic(spark, sf_dir)))
    P.run_to_end(P.windowed_prices(raw), out, checkpoint, ("date",))
    return plain(spark.read.parquet(out).drop("date"), "avg_price")


@query(with_ctes(QUOTES, STORED_VOLUMES, windows_sql(60, 30, "stored"), select=WINDOW_VOLUMES_OUT + CLOSED + PER_WINDOW))
def stream_window_volumes(spark, sf_dir):
    own = stream_session(spark)
    out, checkpoint = _dirs(spark, "stream-window-volumes")
    raw = P.raw_volumes(stream_messages(own, volume_topic(spark, sf_dir)))
    P.run_to_end(P.windowed_volumes(raw), out, checkpoint, ("date",))
    return plain(spark.read.parquet(out).drop("date"), "avg_volume", "avg_price")


# Arrival in portions -------------------------------------------------------
# A message with k in its payload arrives k hours late. What arrived before
# January 11th, before January 21st and after that makes three portions.

ARRIVALS = """arrivals AS (
  SELECT *, CASE WHEN event_timestamp + to_hours(volume) < TIMESTAMP '2024-01-11' THEN 1
                 WHEN event_timestamp + to_hours(volume) < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS portion
  FROM stored)"""


def _portions(spark, sf_dir) -> list[DataFrame]:
    rows = X.quotes(spark, sf_dir).withColumn(
        "arrived", F.col("event_timestamp") + F.make_dt_interval(hours=F.col("volume").cast("int")))
    first, second = (F.coalesce(F.col("arrived") < F.lit(c).cast("timestamp_ntz"), F.lit(False))
                     for c in ("2024-01-11", "2024-01-21"))
    # without a volume there is no arrival: such a message is in the last portion
    return [X._publish(rows.filter(part), VOLUME_MESSAGE, F.col("tick_id")) for part in (first, ~first & second, ~second)]


@query(with_ctes(QUOTES, STORED_VOLUMES, ARRIVALS, """marks AS (
  SELECT portion, max(max(event_timestamp)) OVER (ORDER BY portion ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 24 HOUR AS watermark FROM arrivals GROUP BY portion),
on_time AS (
  SELECT a.*, date_trunc('hour', event_timestamp) AS window_start,
    date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end
  FROM arrivals a JOIN marks m USING (portion)
  WHERE m.watermark IS NULL OR date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR > m.watermark)""",
    select="""SELECT symbol, window_start, window_end, sum(volume)::BIGINT AS total_volume,
  round(avg(volume), 8) AS avg_volume, max(volume) AS max_volume, round(avg(price), 8) AS avg_price,
  count(*) AS record_count FROM on_time
  WHERE window_end <= (SELECT max(event_timestamp) FROM stored) - INTERVAL 24 HOUR
  GROUP BY symbol, window_start, window_end"""))
def stream_late_data(spark, sf_dir):
    """Hourly windows, a day of grace. Each portion is worked off by its own run of
    one query, so its rows are judged by the watermark that earlier portions left."""
    own = stream_session(spark)
    topic = fresh_dir(spark, "late-topic")
    out, checkpoint = _dirs(spark, "stream-late")
    settings = P.StreamSettings(trigger=None, watermark_delay="24 hours", window="1 hour", slide=None)
    for portion in _portions(spark, sf_dir):
        publish_messages(portion, topic)
        windows = P.windowed_volumes(P.raw_volumes(stream_messages(own, topic)), settings)
        P.run_to_end(windows, out, checkpoint, ("date",), settings)
    return plain(spark.read.parquet(out).drop("date"), "avg_volume", "avg_price")


@query(with_ctes(QUOTES, STORED_VOLUMES, select="SELECT tick_id AS kafka_offset, symbol, volume, 1::BIGINT AS deliveries FROM stored"))
def stream_restart_exactly_once(spark, sf_dir):
    """Stopped and started again between portions, each message is stored once."""
    topic = fresh_dir(spark, "restart-topic")
    out, checkpoint = _dirs(spark, "stream-restart")
    for portion in _portions(spark, sf_dir):
        publish_messages(portion, topic)
        P.run_to_end(P.raw_volumes(stream_messages(spark, topic)), out, checkpoint, BY_DAY)
    stored = spark.read.schema(RAW_VOLUMES).parquet(out)
    return stored.groupBy("kafka_offset", "symbol", "volume").agg(F.count("*").alias("deliveries"))


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT run, symbol, count(*) AS rows, sum(volume)::BIGINT AS volume
  FROM stored CROSS JOIN (VALUES (1), (2)) t(run) GROUP BY ALL"""))
def stream_replay(spark, sf_dir):
    """A new checkpoint reads the topic again from its first message."""
    topic = volume_topic(spark, sf_dir)
    runs = []
    for run in (1, 2):
        out, checkpoint = _dirs(spark, "stream-replay")
        P.run_to_end(P.raw_volumes(stream_messages(spark, topic, starting_offsets="earliest")), out, checkpoint, BY_DAY)
        runs.append(spark.read.schema(RAW_VOLUMES).parquet(out).select(F.lit(run).alias("run"), "symbol", "volume"))
    return runs[0].unionAll(runs[1]).groupBy("run", "symbol").agg(
        F.count("*").alias("rows"), F.sum("volume").alias("volume"))


# Run modes and progress ----------------------------------------------------

@query(with_ctes(TICKS, STORED_PRICES, windows_sql(60, 30, "stored"), select=f"""
  SELECT 'prices/raw' AS output, count(*) AS rows FROM stored
  UNION ALL SELECT 'volumes/raw', count(*) FROM stored
  UNION ALL SELECT output, (SELECT count(*) FROM (SELECT DISTINCT symbol, window_start FROM windowed {CLOSED}))
    FROM (VALUES ('prices/aggregated'), ('volumes/aggregated')) t(output)"""))
def run_all_streams(spark, sf_dir):
    own = stream_session(spark)
    root = fresh_dir(spark, "stream-all")
    settings = P.StreamSettings(trigger=None, partitions=BY_DAY)
    running = P.start_streams(own, "all", price_topic(spark, sf_dir), volume_topic(spark, sf_dir),
                              f"{root}/out", f"{root}/checkpoints", settings)
    P.wait(own, running, settings)
    out = None
    for name in (n for n in running if not n.endswith("/rejects")):
        rows = spark.read.parquet(f"{root}/out/{name}").agg(F.lit(name).alias("output"), F.count("*").alias("rows"))
        out = rows if out is None else out.unionAll(rows)
    return out


@query("SELECT 'volumes' AS query, count(*) AS input_rows, 0::BIGINT AS late_rows, TRUE AS timed FROM events")
def stream_progress(spark, sf_dir):
    own = stream_session(spark)
    out, checkpoint = _dirs(spark, "stream-progress")
    raw = P.raw_volumes(stream_messages(own, volume_topic(spark, sf_dir)))
    done = P.run_to_end(P.windowed_volumes(raw), out, checkpoint, ("date",))
    return progress_frame(spark, {"volumes": done}).groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.bool_and(F.col("batch_ms") >= 0).alias("timed"))
