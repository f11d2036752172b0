"""Message topics as envelope frames.

Two backings give the same five envelope columns. ``files`` is a folder of
envelope Parquet files. ``kafka`` uses Spark's Kafka connector, which must be on
the class path of the cluster; it could not be exercised where this was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwell.schemas import ENVELOPE


def _kafka_options(source: str, bootstrap_servers: str, starting_offsets: str,
                   fail_on_data_loss: bool, min_partitions: int | None) -> dict[str, str]:
    # No group id: queries that share one disturb each other's partition assignment.
    # With minPartitions, Spark splits a topic partition that a hot key has filled.
    return ({"minPartitions": str(min_partitions)} if min_partitions else {}) | {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": source,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def stream_messages(spark: SparkSession, source: str, backing: str = "files", *,
                    bootstrap_servers: str = "localhost:9092", starting_offsets: str = "latest",
                    fail_on_data_loss: bool = False, min_partitions: int | None = None,
                    files_per_trigger: int | None = None,
                    offsets_per_trigger: int | None = None) -> DataFrame:
    """Unbounded read. ``source`` is a topic name (kafka) or a folder (files).

    Offsets live in the query's checkpoint; ``starting_offsets`` counts only for a
    new checkpoint. The per-trigger limits bound one micro-batch during catch-up.
    """
    if backing == "kafka":
        reader = spark.readStream.format("kafka").options(
            **_kafka_options(source, bootstrap_servers, starting_offsets, fail_on_data_loss, min_partitions))
        if offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
        return reader.load().select(*ENVELOPE.fieldNames())
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(source)


def drain_messages(spark: SparkSession, source: str, backing: str = "files", *,
                   bootstrap_servers: str = "localhost:9092", fail_on_data_loss: bool = False,
                   min_partitions: int | None = None) -> DataFrame:
    """Bounded read from the earliest message to the end as of now."""
    if backing == "kafka":
        options = _kafka_options(source, bootstrap_servers, "earliest", fail_on_data_loss, min_partitions)
        return (spark.read.format("kafka").options(**options)
                .option("endingOffsets", "latest").load().select(*ENVELOPE.fieldNames()))
    return spark.read.schema(ENVELOPE).parquet(source)


def publish_messages(envelope: DataFrame, target: str, backing: str = "files", *,
                     bootstrap_servers: str = "localhost:9092") -> None:
    """Append envelope rows to a topic. Kafka picks partition and offset itself."""
    if backing == "kafka":
        (envelope.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", target).save())
        return
    envelope.write.mode("append").parquet(target)
