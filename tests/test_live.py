"""Streams with state: what is remembered, forgotten and reported."""

import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwell.schemas import ENVELOPE
from tickwell.session import setting, stream_session
from tickwell.sources.messages import publish_messages, stream_messages
from tickwell.streaming import alerts, stateful
from tickwell.streaming import pipelines as P
from tickwell.streaming.progress import ProgressLog

BASE = datetime(2024, 1, 1)
TO_END = P.StreamSettings(trigger=None)


def publish(spark, path, *rows):
    """(symbol, minute, price, volume, offset)"""
    messages = [(s.encode(), f'{{"symbol": "{s}", "timestamp": "{(BASE + timedelta(minutes=m)).isoformat()}Z", "price": {p}, "volume": {v}}}'.encode(),
                 0, o, BASE) for s, m, p, v, o in rows]
    publish_messages(spark.createDataFrame(messages, ENVELOPE).coalesce(1), path)


def clean(spark, folder, delay):
    own = stream_session(spark)
    P.run_to_end(stateful.clean_stream(P.raw_volumes(stream_messages(own, f"{folder}/topic")), delay),
                 f"{folder}/out", f"{folder}/checkpoint", ("year",))
    return sorted((r.symbol, r.event_timestamp.minute, r.kafka_offset) for r in spark.read.parquet(f"{folder}/out").collect())


def test_repeated_deliveries_are_dropped_over_a_restart(spark, folder):
    publish(spark, f"{folder}/topic", ("A", 1, 1.0, 1, 0), ("A", 1, 1.0, 1, 1), ("B", 1, 1.0, 1, 2), ("A", 2, -1.0, 1, 3))
    assert [x[:2] for x in clean(spark, folder, "1 hour")] == [("A", 1), ("B", 1)]
    publish(spark, f"{folder}/topic", ("A", 1, 1.0, 1, 10), ("A", 5, 1.0, 1, 11), ("B", 1, 1.0, 1, 12))
    assert [x[:2] for x in clean(spark, folder, "1 hour")] == [("A", 1), ("A", 5), ("B", 1)]


def test_what_comes_after_the_delay_is_late(spark, folder):
    publish(spark, f"{folder}/topic", ("A", 1, 1.0, 1, 0))
    publish(spark, f"{folder}/topic", ("A", 50, 1.0, 1, 1))
    clean(spark, folder, "10 minutes")
    publish(spark, f"{folder}/topic", ("A", 1, 1.0, 1, 2), ("C", 2, 1.0, 1, 3), ("C", 45, 1.0, 1, 4))
    assert [x[:2] for x in clean(spark, folder, "10 minutes")] == [("A", 1), ("A", 50), ("C", 45)]


@pytest.mark.parametrize("make, schema, want", [
    (stateful.running_volume, "symbol string, cumulative_volume long, ticks long", {"A": (17, 4), "B": (5, 1)}),
    (stateful.newest_price, "symbol string, event_timestamp timestamp, price double", {"A": (BASE + timedelta(minutes=9), 4.0), "B": (BASE, 9.0)})])
def test_counters_and_gauges_go_on_after_a_restart(spark, folder, make, schema, want):
    from pyspark.sql.types import _parse_datatype_string
    portions = [[("A", 9, 3.0, 10, 1), ("B", 0, 9.0, 5, 2)], [("A", 2, 2.0, 4, 3)], [("A", 9, 4.0, 2, 5), ("A", 9, 3.5, 1, 4)]]
    for rows in portions:
        publish(spark, f"{folder}/topic", *rows)
        df = make(P.raw_volumes(stream_messages(stream_session(spark), f"{folder}/topic")))
        stateful.start_updates(df, f"{folder}/out", f"{folder}/checkpoint", TO_END).awaitTermination()
    got = stateful.newest_state(spark, f"{folder}/out", _parse_datatype_string(schema)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want
    # a batch writes only the symbols it touched
    assert spark.read.parquet(f"{folder}/out").where("symbol = 'B'").count() == 1


class Remembered:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def followed(rule, *batches):
    rule.run = Remembered()
    out = []
    for rows in batches:
        frames = rule.handleInputRows(None, iter([pd.DataFrame(rows, columns=["bucket", "value"])]), None)
        out += [(e.state, int((e.at - pd.Timestamp(0)).total_seconds() // 300), e.windows, e.min_value) for f in frames for e in f.itertuples()]
    return out


def low(for_seconds=600):
    return alerts.SustainedRule("low", "warning", 0.1, None, 300, for_seconds)


def test_a_rule_fires_once_and_resolves():
    assert followed(low(), [(0, 0.5), (1, 0.05), (2, 0.01), (3, 0.0), (4, 0.2)]) == [("firing", 3, 2, 0.01), ("resolved", 4, 3, 0.0)]
    # over batches, out of order within one, and with too short a run first
    assert followed(low(), [(1, 0.0), (0, 0.5)], [(2, 0.5)], [(3, 0.0)], [(4, 0.0)], [(5, 0.0)], [(6, 1.0)]) == [
        ("firing", 5, 2, 0.0), ("resolved", 6, 3, 0.0)]


def test_missing_windows_are_silence():
    assert followed(low(), [(0, 0.5)], [(10, 0.5)]) == [("firing", 3, 9, 0.0), ("resolved", 10, 9, 0.0)]
    high = alerts.SustainedRule("high", "critical", None, 0.1, 300, 300)
    assert followed(high, [(0, 0.5), (4, 0.05)]) == [("firing", 1, 1, 0.5), ("resolved", 1, 1, 0.5)]
    assert followed(high, [(0, 0.1)], [(1, 0.2)]) == [("firing", 2, 1, 0.2)]


def test_silence_fires_by_the_clock(spark, folder):
    """No message at all: only beats come in."""
    own = stream_session(spark, 2)
    publish(spark, f"{folder}/topic", ("A", 0, 1.0, 1, 0))
    messages = stream_messages(own, f"{folder}/topic").select(F.col("timestamp").alias("event_timestamp")).where("false")
    events = alerts.low_ingestion(messages, alerts.heartbeats(own, 1), 0.1, window_seconds=1, for_seconds=2, delay="0 seconds")
    running = (events.writeStream.format("memory").queryName("silence").option("checkpointLocation", f"{folder}/checkpoint")
               .trigger(processingTime="1 second").start())
    try:
        end = time.time() + 60
        while time.time() < end and own.table("silence").count() == 0:
            time.sleep(0.5)
        got = own.table("silence").collect()
    finally:
        running.stop()
    assert [r.state for r in got] == ["firing"] and got[0].at - got[0].breached_from == timedelta(seconds=2)


def test_progress_log_keeps_every_batch(spark, folder):
    own = stream_session(spark)
    for k in range(5):
        publish(spark, f"{folder}/topic", ("A", k, 1.0, 1, k))
    with setting(own, "spark.sql.streaming.numRecentProgressUpdates", "2"), ProgressLog(own, f"{folder}/log", every=2) as log:
        raw = P.raw_volumes(stream_messages(own, f"{folder}/topic", files_per_trigger=1))
        done = P.start_parquet(raw, f"{folder}/out", f"{folder}/checkpoint", TO_END, ("year",), "volumes")
        done.awaitTermination()
        log.wait_for(done)
    rows = log.rows().where("input_rows > 0").collect()
    assert len(done.recentProgress) <= 2 and sorted(r.batch_id for r in rows) == [0, 1, 2, 3, 4]
    assert {r.query for r in rows} == {"volumes"} and sum(r.input_rows for r in rows) == 5
