"""Streaming pipelines: raw ticks, windowed aggregates, sinks and run modes.

The transforms are those of the batch jobs. Windowed aggregates run in append mode
and therefore carry a watermark: a window is written once, when event time has
passed its end by the allowed delay; rows later than that are dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwell.functions.ticks import (parse_messages, price_pipeline, volume_pipeline, with_date_parts, with_event_time,
                                      with_processing_time)
from tickwell.operators.cleaning import reject_reason
from tickwell.operators.daily import window_prices, window_volumes
from tickwell.schemas import DAY_PARTITIONS, PRICE_MESSAGE, RAW_PARTITIONS, REJECTS, VOLUME_MESSAGE
from tickwell.session import folders_in_parallel
from tickwell.sources.messages import stream_messages

#: Files that a batch writes for a date of windows, at most.
SPREAD = 8

MODES = ("all", "prices", "volumes", "aggregated")


@dataclass(frozen=True)
class StreamSettings:
    """How queries run. ``trigger`` is a processing-time interval, or ``None`` to
    work off what is there and stop."""

    trigger: str | None = "10 seconds"
    watermark_delay: str = "1 minute"
    window: str = "1 minute"
    slide: str | None = "30 seconds"
    partitions: tuple[str, ...] = RAW_PARTITIONS

    def trigger_options(self) -> dict:
        return {"availableNow": True} if self.trigger is None else {"processingTime": self.trigger}


def target_uri(path: str, base: str = "") -> str:
    """A path with a scheme stands as it is; any other is placed under ``base``."""
    return path if "://" in path or not base else f"{base.rstrip('/')}/{path.lstrip('/')}"


def raw_prices(messages: DataFrame) -> DataFrame:
    return price_pipeline(messages, PRICE_MESSAGE)


def raw_volumes(messages: DataFrame) -> DataFrame:
    return volume_pipeline(messages, VOLUME_MESSAGE)


def _windowed(aggregate: Callable[..., DataFrame], raw: DataFrame, settings: StreamSettings) -> DataFrame:
    on_time = raw.withWatermark("event_timestamp", settings.watermark_delay)
    return (aggregate(on_time, settings.window, settings.slide)
            .withColumn("date", F.to_date("window_start"))
            # few files for each date, yet a first start that closes whole days at once has more than a task for each
            .repartition("date", F.pmod(F.xxhash64("symbol"), F.lit(SPREAD))))


def windowed_prices(raw: DataFrame, settings: StreamSettings = StreamSettings()) -> DataFrame:
    return _windowed(window_prices, raw, settings)


def windowed_volumes(raw: DataFrame, settings: StreamSettings = StreamSettings()) -> DataFrame:
    return _windowed(window_volumes, raw, settings)


def rejected(messages: DataFrame) -> DataFrame:
    """What the raw pipelines leave out, with the reason, by the day the message came in. The
    fields of both kinds of message that matter here are those of the volume message."""
    parsed = with_event_time(with_processing_time(parse_messages(messages, VOLUME_MESSAGE)))
    return (with_date_parts(parsed.withColumn("reason", reject_reason()), "kafka_timestamp")
            .filter(F.col("reason").isNotNull()).select(*REJECTS.fieldNames()))


def gathered(raw: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """For stateless streams: the rows of a folder in few files. The sizes of a batch are known
    before it is written, so AQE splits a folder with far more rows than the others."""
    return raw.hint("rebalance", *partitions)


def start_parquet(df: DataFrame, path: str, checkpoint: str, settings: StreamSettings,
                  partitions: tuple[str, ...], name: str | None = None) -> StreamingQuery:
    """Append to partitioned Parquet. The sink's log makes every batch count once;
    the URI decides between object store, HDFS and local files."""
    writer = (df.writeStream.outputMode("append").format("parquet")
              .partitionBy(*partitions)
              .option("path", path).option("checkpointLocation", checkpoint)
              .trigger(**settings.trigger_options()))
    with folders_in_parallel(df.sparkSession):  # a query keeps the settings it was started with
        return (writer.queryName(name) if name else writer).start()


def start_fan_out(df: DataFrame, paths: list[str], checkpoint: str, settings: StreamSettings,
                  partitions: tuple[str, ...] = (), name: str | None = None) -> StreamingQuery:
    """One read of the stream, several targets.

    Below the given partitions each batch has its own ``batch_id`` folders. A batch
    repeated after a failure has the same rows and so replaces what it wrote before.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # AQE gathers the rows of a folder into few files, and splits a folder with far more rows
        batch = batch.withColumn("batch_id", F.lit(batch_id))
        if partitions:
            batch = gathered(batch, partitions)
        if len(paths) > 1:
            batch = batch.persist()
        try:
            for path in paths:
                (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(*partitions, "batch_id").parquet(path))
        finally:
            batch.unpersist()

    writer = (df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
              .trigger(**settings.trigger_options()))
    return (writer.queryName(name) if name else writer).start()


def start_streams(spark: SparkSession, mode: str, prices_source: str, volumes_source: str, output: str,
                  checkpoints: str, settings: StreamSettings = StreamSettings(),
                  second_output: str | None = None, **source_options) -> dict[str, StreamingQuery]:
    """Starts the queries of a run mode, by the path of their output.

    With ``second_output``, raw ticks are read once and written to both places.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")

    def read(source: str) -> DataFrame:
        return stream_messages(spark, source, **source_options)

    plans = {}
    if mode in ("all", "prices"):
        plans["prices/raw"] = (raw_prices(read(prices_source)), settings.partitions)
        plans["prices/rejects"] = (rejected(read(prices_source)), DAY_PARTITIONS)
    if mode in ("all", "volumes"):
        plans["volumes/raw"] = (raw_volumes(read(volumes_source)), settings.partitions)
        plans["volumes/rejects"] = (rejected(read(volumes_source)), DAY_PARTITIONS)
    if mode in ("all", "aggregated"):
        plans["prices/aggregated"] = (windowed_prices(raw_prices(read(prices_source)), settings), ("date",))
        plans["volumes/aggregated"] = (windowed_volumes(raw_volumes(read(volumes_source)), settings), ("date",))
    started = {}
    for name, (df, partitions) in plans.items():
        checkpoint = f"{checkpoints}/{name}"
        if second_output and name.endswith("/raw"):
            started[name] = start_fan_out(df, [f"{output}/{name}", f"{second_output}/{name}"], checkpoint,
                                          settings, partitions)
        else:
            started[name] = start_parquet(df if name.endswith("/aggregated") else gathered(df, partitions), f"{output}/{name}", checkpoint, settings, partitions)
    return started


def wait(spark: SparkSession, queries: dict[str, StreamingQuery], settings: StreamSettings) -> None:
    """Waits for the queries. Unbounded ones: until the first of them ends, raising
    its error, whichever it is. Bounded ones: until all are done."""
    if settings.trigger is None:
        for query in queries.values():
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def run_to_end(df: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...],
               settings: StreamSettings | None = None) -> StreamingQuery:
    """Works off everything available and returns the finished query."""
    query = start_parquet(df, path, checkpoint, settings or StreamSettings(trigger=None), partitions)
    query.awaitTermination()
    return query
