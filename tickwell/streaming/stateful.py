"""Streams with state by key: cleaning of repeated deliveries, running totals, newest prices.

Totals and newest rows have one row of state for each symbol and need no watermark. They run in update
mode: a batch writes the symbols it touched, and ``newest_state`` reads what is current.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickwell.operators.cleaning import KEY
from tickwell.streaming.pipelines import StreamSettings


def clean_stream(raw: DataFrame, delay: str) -> DataFrame:
    """Valid ticks of a raw stream, one for each symbol and event time: the one that came first.

    A key is remembered until the watermark has passed its time by ``delay``, so state is as large as
    ``delay`` is long. Repeated deliveries within it are dropped; later ones are dropped as late.
    The batch job sees all deliveries and keeps the one with the latest offset instead.
    """
    return raw.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(list(KEY))


def running_volume(raw: DataFrame) -> DataFrame:
    """Counters that only grow: volume and ticks of each symbol since the stream began."""
    return raw.groupBy("symbol").agg(F.sum("volume").alias("cumulative_volume"), F.count("*").alias("ticks"))


def newest_price(raw: DataFrame) -> DataFrame:
    """A gauge: each symbol's newest price by event time; of equal times the latest offset counts."""
    newest = F.max(F.struct("event_timestamp", "kafka_offset", "kafka_partition", "price"))
    return raw.groupBy("symbol").agg(newest.alias("newest")).select(
        "symbol", F.col("newest.event_timestamp").alias("event_timestamp"), F.col("newest.price").alias("price"))


def start_updates(df: DataFrame, path: str, checkpoint: str, settings: StreamSettings, name: str | None = None) -> StreamingQuery:
    """Writes what each batch changed to a folder of its own. A batch repeated after a failure
    has the same rows and replaces what it wrote before."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    writer = (df.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
              .trigger(**settings.trigger_options()))
    return (writer.queryName(name) if name else writer).start()


def newest_state(spark: SparkSession, path: str, schema: StructType, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """The current row of each key: that of the newest batch that changed it."""
    rows = spark.read.schema(StructType(schema.fields).add("batch_id", "long")).parquet(path)
    rest = [f for f in schema.fieldNames() if f not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
