import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickwell.functions.ticks import iso_text, to_envelope
from tickwell.schemas import PRICE_MESSAGE, RAW_PARTITIONS, RAW_PRICES, RAW_VOLUMES, REJECTS, VOLUME_MESSAGE
from tickwell.session import stream_session
from tickwell.sources.days import read_days
from tickwell.sources.messages import drain_messages, publish_messages, stream_messages
from tickwell.streaming import pipelines as P
from tickwell.streaming.progress import progress_frame

TO_END = P.StreamSettings(trigger=None)
_next_offset = iter(range(10_000))


def minute(text):
    m, s = text.split(":")
    return datetime(2024, 1, 1, 0, int(m), int(s))


def publish(spark, topic, *times, symbol="A", price=1.0):
    """One file per call, so that one call is one micro-batch."""
    rows = [(next(_next_offset), symbol, minute(t), price, 10) for t in times]
    df = spark.createDataFrame(rows, "id bigint, symbol string, event_timestamp timestamp_ntz, price double, volume bigint")
    sent = to_envelope(df.withColumn("timestamp", iso_text("event_timestamp")), VOLUME_MESSAGE, F.lit(0), F.col("id"),
                       F.col("event_timestamp"))
    publish_messages(sent.coalesce(1), topic)
    time.sleep(1.1)  # file order is by modification time


def run_windows(spark, topic, folder, slide=None, **settings):
    own = stream_session(spark, 2)
    chosen = P.StreamSettings(trigger=None, slide=slide, **settings)
    raw = P.raw_volumes(stream_messages(own, topic, files_per_trigger=1))
    return P.run_to_end(P.windowed_volumes(raw, chosen), f"{folder}/out", f"{folder}/checkpoint", ("date",), chosen)


def windows(spark, folder):
    return {r.window_start.strftime("%M:%S"): r.record_count for r in spark.read.parquet(f"{folder}/out").collect()}


def test_late_rows_over_micro_batches_and_a_restart(spark, folder):
    topic = f"{folder}/topic"
    publish(spark, topic, "00:10", "01:10")
    publish(spark, topic, "10:00")
    publish(spark, topic, "00:20", "09:30", "11:00")
    publish(spark, topic, "00:30", "20:00")
    query = run_windows(spark, topic, folder)
    # 00:20 is judged by the watermark of the batch before, which had seen 01:10 only.
    assert windows(spark, folder) == {"00:00": 2, "01:00": 1, "09:00": 1, "10:00": 1, "11:00": 1}
    progress = progress_frame(spark, {"w": query}).agg(F.sum("input_rows"), F.sum("late_rows")).first()
    assert tuple(progress) == (8, 1)
    publish(spark, topic, "20:30", "40:00")
    run_windows(spark, topic, folder)
    assert windows(spark, folder) == {"00:00": 2, "01:00": 1, "09:00": 1, "10:00": 1, "11:00": 1, "20:00": 2}


def test_raw_output_layout_and_exactly_once(spark, folder):
    topic, out = f"{folder}/topic", f"{folder}/out"
    publish(spark, topic, "00:10", "01:10")
    publish(spark, topic, "02:00", symbol="B")
    publish(spark, topic, "03:00", price=-1.0)
    for _ in range(2):  # the second run finds nothing new
        raw = P.raw_volumes(stream_messages(spark, topic))
        P.run_to_end(raw, out, f"{folder}/checkpoint", RAW_PARTITIONS)
    stored = spark.read.schema(RAW_VOLUMES).parquet(out)
    assert sorted(r.symbol for r in stored.collect()) == ["A", "A", "B"]
    assert os.path.isdir(f"{out}/year=2024/month=1/day=1/hour=0/symbol=A")
    # A file that no batch committed is not part of the day.
    rogue = f"{out}/year=2024/month=1/day=1/hour=0/symbol=A"
    stored.limit(1).select("volume", "price").write.mode("append").parquet(rogue)
    assert read_days(spark, out, RAW_VOLUMES, "2024-01-01").count() == 3


def test_fan_out_repeats_a_batch_without_duplicates(spark, folder):
    topic = f"{folder}/topic"
    publish(spark, topic, "00:10", "01:10")
    raw = P.raw_volumes(stream_messages(spark, topic))
    paths = [f"{folder}/a", f"{folder}/b"]
    for checkpoint in ("one", "two"):  # a lost commit makes Spark repeat batch 0
        P.start_fan_out(raw, paths, f"{folder}/{checkpoint}", TO_END, ("symbol",)).awaitTermination()
    assert [spark.read.parquet(p).count() for p in paths] == [2, 2]


def test_second_output_keeps_the_day_layout(spark, folder):
    topic = f"{folder}/topic"
    own = stream_session(spark, 2)
    for times in (("00:10", "01:10"), ("30:00",)):
        publish(spark, topic, *times)
        queries = P.start_streams(own, "volumes", topic, topic, f"{folder}/a", f"{folder}/checkpoints", TO_END,
                                  second_output=f"{folder}/b")
        P.wait(own, queries, TO_END)
    for root in ("a", "b"):
        day = read_days(spark, f"{folder}/{root}/volumes/raw", RAW_VOLUMES, "2024-01-01")
        assert day.count() == 3 and day.schema.fieldNames() == RAW_VOLUMES.fieldNames()


def test_bad_messages_do_not_stop_the_stream(spark, folder):
    topic = f"{folder}/topic"
    publish(spark, topic, "00:10")
    bad = spark.createDataFrame([(None, b"{broken", 0, 1, datetime(2024, 1, 1)), (None, None, 0, 2, datetime(2024, 1, 1))],
                                "key binary, value binary, partition int, offset bigint, timestamp timestamp")
    publish_messages(bad, topic)
    P.run_to_end(P.raw_prices(stream_messages(spark, topic)), f"{folder}/out", f"{folder}/checkpoint", ("year",))
    assert spark.read.schema(RAW_PRICES).parquet(f"{folder}/out").count() == 1
    assert drain_messages(spark, topic).count() == 3
    P.run_to_end(P.rejected(stream_messages(spark, topic)), f"{folder}/rejects", f"{folder}/checkpoint-2", ("year",))
    lost = spark.read.schema(REJECTS).parquet(f"{folder}/rejects")
    assert sorted((r.kafka_offset, r.reason) for r in lost.collect()) == [(1, "malformed"), (2, "malformed")]


@pytest.mark.parametrize("mode, outputs", [("prices", {"prices/raw", "prices/rejects"}), ("volumes", {"volumes/raw", "volumes/rejects"}),
                                           ("aggregated", {"prices/aggregated", "volumes/aggregated"})])
def test_run_modes(spark, folder, mode, outputs):
    topic = f"{folder}/topic"
    publish(spark, topic, "00:10", "30:00")
    own = stream_session(spark, 2)
    queries = P.start_streams(own, mode, topic, topic, f"{folder}/out", f"{folder}/checkpoints", TO_END)
    P.wait(own, queries, TO_END)
    assert set(queries) == outputs
    assert all(spark.read.parquet(f"{folder}/out/{name}").count() >= 1 for name in outputs if not name.endswith("/rejects"))


def test_wait_raises_the_error_of_any_query(spark, folder):
    topic = f"{folder}/topic"
    publish(spark, topic, "00:10")
    own = stream_session(spark, 2)
    own.streams.resetTerminated()
    settings = P.StreamSettings(trigger="100 milliseconds")
    good = P.start_parquet(P.raw_volumes(stream_messages(own, topic)), f"{folder}/a", f"{folder}/ca", settings, ("year",))
    failing = P.raw_volumes(stream_messages(own, topic)).withColumn("boom", F.raise_error(F.lit("boom")))
    bad = P.start_parquet(failing, f"{folder}/b", f"{folder}/cb", settings, ("year",))
    try:
        with pytest.raises(Exception, match="boom"):
            P.wait(own, {"good": good, "bad": bad}, settings)
    finally:
        good.stop()
        bad.stop()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        P.start_streams(spark, "none", "a", "b", "c", "d")


def test_target_uri():
    assert P.target_uri("/stock/raw", "hdfs://node:9000") == "hdfs://node:9000/stock/raw"
    assert P.target_uri("s3a://bucket/raw", "hdfs://node:9000") == "s3a://bucket/raw"


def test_stream_session_leaves_the_caller_alone(spark):
    own = stream_session(spark, 3)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_price_schema_is_the_message(spark):
    assert RAW_PRICES.fieldNames()[4:14] == PRICE_MESSAGE.fieldNames()
