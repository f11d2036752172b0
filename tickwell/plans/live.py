"""Streams with state, run over portions of the given data with a restart between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.plans import frames as X
from tickwell.plans.frames import DIRTY, QUOTES, STORED_VOLUMES, plain, with_ctes
from tickwell.plans.monitoring import OUTAGE
from tickwell.plans.registry import query
from tickwell.plans.storage import volume_topic
from tickwell.plans.streams import BY_DAY, TO_END, _dirs, _portions
from tickwell.schemas import RAW_VOLUMES, VOLUME_MESSAGE
from tickwell.session import fresh_dir, setting, stream_session
from tickwell.sources.messages import publish_messages, stream_messages
from tickwell.streaming import alerts, pipelines as P, stateful
from tickwell.streaming.progress import ProgressLog


# Cleaning -------------------------------------------------------------------

@query(with_ctes(DIRTY, select="""SELECT symbol, event_timestamp, price, volume FROM dirty
  WHERE copy = 0 AND symbol IS NOT NULL AND price > 0 AND NOT cut_short AND NOT bad_time"""))
def stream_clean_ticks(spark, sf_dir):
    """Damaged ticks in three portions of ten days. Second deliveries come with the portion after that of the
    first, so the state that an earlier run left drops them."""
    own = stream_session(spark)
    topic = fresh_dir(spark, "clean-topic")
    out, checkpoint = _dirs(spark, "stream-clean")
    messages = X.dirty_messages(spark, sf_dir)
    again = F.col("offset") >= 1_000_000_000_000
    portion = F.least(F.floor((F.dayofmonth("timestamp") - 1) / 10), F.lit(2))
    arrived = F.least(portion + again.cast("int"), F.lit(2))
    for k in range(3):
        publish_messages(messages.where(arrived == k), topic)
        clean = stateful.clean_stream(P.raw_volumes(stream_messages(own, topic)), "22 days")
        P.run_to_end(clean, out, checkpoint, BY_DAY)
    return plain(spark.read.schema(RAW_VOLUMES).parquet(out).select("symbol", "event_timestamp", "price", "volume"))


# Counters and gauges ----------------------------------------------------------

def _live(spark, sf_dir, label, make, schema: str) -> DataFrame:
    own = stream_session(spark)
    topic = fresh_dir(spark, f"{label}-topic")
    out, checkpoint = _dirs(spark, label)
    for portion in _portions(spark, sf_dir):
        publish_messages(portion, topic)
        df = make(P.raw_volumes(stream_messages(own, topic)))
        stateful.start_updates(df, out, checkpoint, TO_END).awaitTermination()
    return plain(stateful.newest_state(spark, out, T._parse_datatype_string(schema)))


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT symbol, sum(volume)::BIGINT AS cumulative_volume, count(*) AS ticks
  FROM stored GROUP BY symbol"""))
def stream_cumulative_volume(spark, sf_dir):
    """The counters after three portions and two restarts."""
    return _live(spark, sf_dir, "stream-counters", stateful.running_volume, "symbol string, cumulative_volume long, ticks long")


@query(with_ctes(QUOTES, STORED_VOLUMES, select="""SELECT symbol, max(event_timestamp) AS event_timestamp,
  arg_max(price, event_timestamp) AS price FROM stored GROUP BY symbol"""))
def stream_latest_price(spark, sf_dir):
    """The gauges, whatever order ticks came in."""
    return _live(spark, sf_dir, "stream-gauges", stateful.newest_price, "symbol string, event_timestamp timestamp, price double")


# Alerts -----------------------------------------------------------------------

SINCE, UNTIL = "2023-12-31 22:00:00", "2024-02-01 03:00:00"


@query(with_ctes(QUOTES, OUTAGE, """runs AS (
  SELECT min(bucket) AS bucket, count(*) AS windows FROM (
    SELECT *, bucket - row_number() OVER (ORDER BY bucket) AS run FROM series WHERE value < 0.002) GROUP BY run)""", select="""
  SELECT 'LowDataIngestionRate' AS alert, 'warning' AS severity, state, make_timestamp(moment * 300 * 1000000) AS "at",
         make_timestamp(bucket * 300 * 1000000) AS breached_from
  FROM runs, LATERAL (VALUES ('firing', bucket + 2), ('resolved', bucket + windows)) t(state, moment)
  WHERE windows >= 2 AND (state = 'firing' OR bucket + windows <= (SELECT max(bucket) FROM series))"""))
def stream_alert_low_ingestion(spark, sf_dir):
    """The rule of ``alert_outage_until_now`` as a running query over three portions. Beats go on when messages
    have ended, so the last silence fires, and nothing resolves it."""
    own = stream_session(spark)
    topic, clock = fresh_dir(spark, "alert-topic"), fresh_dir(spark, "clock")
    out, checkpoint = _dirs(spark, "stream-alert")
    messages = X.volume_topic(spark, sf_dir)
    # windows close ten minutes late, so beats go on for that long after the last one
    beats = spark.range(1).select(F.explode(F.sequence(
        F.lit(SINCE).cast("timestamp"), F.lit(UNTIL).cast("timestamp") + F.make_dt_interval(mins=F.lit(10)),
        F.make_dt_interval(mins=F.lit(5)))).alias("event_timestamp"))
    cuts = ["0001-01-01", "2024-01-11", "2024-01-21", "9999-12-31"]
    for low, high in zip(cuts, cuts[1:]):
        def within(column: str):
            return (F.col(column) >= F.lit(low).cast("timestamp")) & (F.col(column) < F.lit(high).cast("timestamp"))

        publish_messages(messages.where(within("timestamp")), topic)
        beats.where(within("event_timestamp")).write.mode("append").parquet(clock)
        arrived = P.parse_messages(stream_messages(own, topic), VOLUME_MESSAGE).select(F.col("kafka_timestamp").alias("event_timestamp"))
        ticking = own.readStream.schema("event_timestamp timestamp").parquet(clock)
        events = alerts.low_ingestion(arrived, ticking, threshold=0.002, delay="10 minutes")
        P.run_to_end(events, out, checkpoint, ())
    return plain(spark.read.parquet(out).select("alert", "severity", "state", "at", "breached_from"))


# Triggers and progress -----------------------------------------------------------

@query(with_ctes(QUOTES, STORED_VOLUMES, select="SELECT symbol, count(*) AS rows, sum(volume)::BIGINT AS volume FROM stored GROUP BY symbol"))
def stream_interval_trigger(spark, sf_dir):
    """A query that looks for new messages at an interval, stopped when it has caught up."""
    out, checkpoint = _dirs(spark, "stream-interval")
    raw = P.raw_volumes(stream_messages(spark, volume_topic(spark, sf_dir), files_per_trigger=1))
    running = P.start_parquet(raw, out, checkpoint, P.StreamSettings(trigger="1 second"), BY_DAY)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(RAW_VOLUMES).parquet(out).groupBy("symbol").agg(
        F.count("*").alias("rows"), F.sum("volume").alias("volume"))


@query("SELECT count(*) AS input_rows, 0::BIGINT AS late_rows, TRUE AS timed, TRUE AS beyond_memory FROM events")
def stream_progress_log(spark, sf_dir):
    """Progress of every batch, by a listener, of a query that remembers only its last two."""
    own = stream_session(spark)
    topic = fresh_dir(spark, "progress-topic")
    messages = X.volume_topic(spark, sf_dir)
    for k in range(4):
        publish_messages(messages.where(F.col("offset") % 4 == k).coalesce(1), topic)
    out, checkpoint = _dirs(spark, "stream-progress-log")
    with setting(own, "spark.sql.streaming.numRecentProgressUpdates", "2"), ProgressLog(own, fresh_dir(spark, "progress")) as log:
        raw = P.raw_volumes(stream_messages(own, topic, files_per_trigger=1))
        done = P.run_to_end(raw, out, checkpoint, BY_DAY)
        log.wait_for(done)
        remembered = len(done.recentProgress)
    return log.rows().agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.bool_and(F.col("batch_ms") >= 0).alias("timed"), (F.count_if(F.col("input_rows") > 0) > remembered).alias("beyond_memory"))
