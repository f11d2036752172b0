from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickwell.functions import ticks as T
from tickwell.operators import cleaning
from tickwell.schemas import PRICE_MESSAGE, VOLUME_MESSAGE


def envelope(spark, *values):
    rows = [(b"AAPL", v.encode() if v is not None else None, 0, i, datetime(2025, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, partition int, offset bigint, timestamp timestamp")


SAMPLE = ('{"symbol":"AAPL","timestamp":"2025-11-30T19:45:20.298249","price":278.8599853515625,"open":278.9,'
          '"high":279.0,"low":278.64,"volume":544785,"previous_close":277.55,"market_cap":4138242670592,"currency":"USD"}')


def test_price_message(spark):
    row = T.parse_messages(envelope(spark, SAMPLE), PRICE_MESSAGE).first()
    assert row.kafka_key == "AAPL" and row.kafka_offset == 0
    assert row.price == 278.8599853515625 and row.market_cap == 4138242670592.0 and row.volume == 544785


def test_malformed_and_missing_values_keep_their_row(spark):
    rows = T.parse_messages(envelope(spark, '{"symbol":"AAPL","pri', None, "[]", SAMPLE), PRICE_MESSAGE).collect()
    assert len(rows) == 4
    assert [r.symbol for r in sorted(rows, key=lambda r: r.kafka_offset)] == [None, None, None, "AAPL"]


def test_volume_beyond_int(spark):
    text = '{"symbol":"A","timestamp":"2025-11-30T10:00:00Z","volume":3000000000,"price":1.5}'
    assert T.parse_messages(envelope(spark, text), VOLUME_MESSAGE).first().volume == 3_000_000_000


@pytest.mark.parametrize("text, expected", [
    ("2025-11-30T19:45:20.298249", datetime(2025, 11, 30, 19, 45, 20, 298249)),
    ("2025-11-30T19:45:20.298249+00:00", datetime(2025, 11, 30, 19, 45, 20, 298249)),
    ("2025-11-30T10:00:00Z", datetime(2025, 11, 30, 10, 0)),
    ("2025-11-30T12:00:00+02:00", datetime(2025, 11, 30, 10, 0)),
    ("not-a-time", None),
    (None, None),
])
def test_event_time_spellings(spark, text, expected):
    df = spark.createDataFrame([(text,)], "timestamp string")
    got = T.with_event_time(df).select(F.col("event_timestamp").cast("timestamp_ntz")).first()[0]
    assert got == expected


def test_price_change_without_usable_previous_close(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 0.0), (10.0, None)], "price double, previous_close double")
    rows = [tuple(r) for r in T.with_price_change(df).select("price_change", "price_change_pct").collect()]
    assert rows == [(2.0, 25.0), (10.0, None), (None, None)]


def test_validity(spark):
    df = spark.createDataFrame([("A", 1.0), (None, 1.0), ("A", None), ("A", 0.0), ("A", -1.0)],
                               "symbol string, price double")
    assert [tuple(r) for r in T.valid_ticks(df).collect()] == [("A", 1.0)]


def test_date_parts_and_round_trip(spark):
    df = spark.createDataFrame([("A", datetime(2024, 2, 3, 4, 5, 6, 700), 1.0, 5)],
                               "symbol string, event_timestamp timestamp_ntz, price double, volume bigint")
    parts = T.with_date_parts(df).first()
    assert (parts.year, parts.month, parts.day, parts.hour) == (2024, 2, 3, 4)
    sent = T.to_envelope(df.withColumn("timestamp", T.iso_text("event_timestamp")), VOLUME_MESSAGE,
                         F.lit(0), F.lit(1), F.col("event_timestamp"))
    back = T.with_event_time(T.parse_messages(sent, VOLUME_MESSAGE)).first()
    assert (back.symbol, back.volume, back.price) == ("A", 5, 1.0)
    assert back.timestamp == "2024-02-03T04:05:06.000700Z"


def test_message_text_is_parsed_once(spark, capsys):
    pipeline = T.price_pipeline(envelope(spark, SAMPLE), PRICE_MESSAGE)
    pipeline.explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json") == 1


def test_cleaning_keeps_the_latest_delivery(spark):
    t = datetime(2024, 1, 1)
    rows = [(0, 1, "A", "x", t, 1.0), (0, 9, "A", "x", t, 2.0), (1, 5, "A", "x", t, 3.0), (0, 2, "B", "x", t, 4.0),
            (0, 3, None, "x", t, 1.0), (0, 4, "A", "x", t, None), (0, 6, "A", "x", t, -1.0),
            (0, 7, "A", "x", None, 1.0), (0, 8, None, None, None, None)]
    df = spark.createDataFrame(rows, "kafka_partition int, kafka_offset bigint, symbol string, timestamp string, "
                                     "event_timestamp timestamp, price double")
    kept = {(r.kafka_partition, r.kafka_offset) for r in cleaning.clean_ticks(df).collect()}
    assert kept == {(0, 9), (0, 2)}
    rejected = {(r.kafka_partition, r.kafka_offset): r.reason for r in cleaning.quarantine(df).collect()}
    assert rejected == {(0, 1): "duplicate", (1, 5): "duplicate", (0, 3): "missing symbol", (0, 4): "missing price",
                        (0, 6): "non-positive price", (0, 7): "unreadable time", (0, 8): "malformed"}
