"""One key holds most rows: its work must spread over several tasks."""

import os

import pytest
from pyspark.sql import functions as F

from tickwell.operators import cleaning, daily
from tickwell.operators.lookup import lookup_join
from tickwell.streaming import pipelines
from tickwell.session import setting
from tickwell.sources.days import write_days

N = 400_000


@pytest.fixture
def hot(spark):
    """Ninety percent of the rows belong to one symbol and day."""
    is_hot = F.col("id") % 10 != 0
    return spark.range(0, N, 1, 8).select(
        "id",
        F.when(is_hot, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string"))).alias("symbol"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"),
        F.when(is_hot, 1).otherwise((F.col("id") % 27).cast("int") + 2).alias("day"),
        F.rand(7).alias("price"), F.md5(F.col("id").cast("string")).alias("payload"))


def test_hot_folder_is_written_by_several_tasks(spark, hot, folder):
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m"):
        write_days(hot, folder)
    files = [f for f in os.listdir(f"{folder}/year=2024/month=1/day=1") if f.endswith(".parquet")]
    assert len(files) > 4
    other = [f for f in os.listdir(f"{folder}/year=2024/month=1/day=5") if f.endswith(".parquet")]
    assert len(other) <= 2
    assert spark.read.parquet(folder).count() == N


def test_shuffle_join_splits_the_hot_key(spark, hot, capsys):
    lookup = hot.groupBy("symbol").agg(F.max("price").alias("high"))
    with (setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"),
          setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m"),
          setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "2m")):
        joined = lookup_join(hot, lookup, ["symbol"])
        checked = joined.agg(F.count("*"), F.count_if(F.col("price") <= F.col("high"))).first()
        assert tuple(checked) == (N, N)
        rows = joined.select("id", "payload", "high")
        assert len(rows.collect()) == N
        rows.explain()  # the final plan of the run above
    assert "skew=true" in capsys.readouterr().out


def test_partial_aggregates_carry_one_row_per_task_and_group(spark, hot, capsys):
    ticks = hot.select("symbol", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_timestamp"),
                       "price", F.col("id").alias("volume"))
    day = daily.daily_prices(ticks, measures=daily.CORE_MEASURES)
    assert day.agg(F.sum("record_count")).first()[0] == N
    day.explain()
    assert "partial_avg" in capsys.readouterr().out


def test_tick_delivered_very_often(spark):
    t = F.lit("2024-01-01 00:00:00").cast("timestamp")
    copies = spark.range(0, 100_000, 1, 8).select(
        F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"), F.lit("A").alias("symbol"),
        F.lit("x").alias("timestamp"), t.alias("event_timestamp"), F.lit(1.0).alias("price"))
    assert cleaning.clean_ticks(copies).first().kafka_offset == 99_999
    assert cleaning.quarantine(copies).groupBy("reason").count().collect() == [("duplicate", 99_999)]


def test_stream_writer_splits_a_hot_folder(spark, hot, folder):
    """Files of a folder are split by their size, not by a fixed number of tasks."""
    source = f"{folder}/source"
    hot.withColumn("day", F.lit(1)).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m"):
        pipelines.run_to_end(pipelines.gathered(stream, ("day",)), f"{folder}/out", f"{folder}/checkpoint", ("day",))
    files = [f for f in os.listdir(f"{folder}/out/day=1") if f.endswith(".parquet")]
    assert len(files) > 4 and spark.read.parquet(f"{folder}/out").count() == N
