"""Message parsing and tick enrichment. Each function is DataFrame -> DataFrame,
made of built-in expressions only, and works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwell.schemas import VOLUME_MESSAGE


def parse_messages(df: DataFrame, schema: StructType, value_column: str = "value") -> DataFrame:
    """Envelope to typed columns. Malformed JSON gives NULL message fields.

    The parsed struct goes through ``inline``: a later filter on message fields is
    then not pushed below the parser, where each field it names would parse the
    text once more.
    """
    body = F.from_json(F.col(value_column).cast("string"), schema)
    return df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(body)),
    )


def with_processing_time(df: DataFrame) -> DataFrame:
    return df.withColumn("processing_timestamp", F.current_timestamp())


def with_event_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """ISO-8601 text to a timestamp: with offset, with ``Z``, or zone-less (session zone).

    Text that is no time gives NULL instead of failing the job.
    """
    return df.withColumn("event_timestamp", F.try_to_timestamp(F.col(column)))


def unreadable_times(column: str = "timestamp") -> Column:
    """Aggregate: how many rows carry a time text that could not be read."""
    return F.count_if(F.col(column).isNotNull() & F.col("event_timestamp").isNull())


def is_valid_tick() -> Column:
    return F.col("symbol").isNotNull() & F.col("price").isNotNull() & (F.col("price") > 0)


def valid_ticks(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_tick())


def dated_ticks(df: DataFrame) -> DataFrame:
    """Ticks whose time could be read. The others would be stored under no day, where no day
    read finds them; they go to the rejects."""
    return df.filter(F.col("event_timestamp").isNotNull())


def with_price_change(df: DataFrame) -> DataFrame:
    """Absolute and percent change; NULL where the previous close is missing or zero."""
    change = F.col("price") - F.col("previous_close")
    return df.withColumns({
        "price_change": change,
        "price_change_pct": F.try_divide(change, F.col("previous_close")) * 100,
    })


def with_date_parts(df: DataFrame, column: str = "event_timestamp") -> DataFrame:
    return df.withColumns({
        "year": F.year(column),
        "month": F.month(column),
        "day": F.dayofmonth(column),
        "hour": F.hour(column),
    })


def volume_messages(df: DataFrame) -> DataFrame:
    """The volume topic carries a projection of the price message."""
    return df.select(*VOLUME_MESSAGE.fieldNames())


def iso_text(column: str | Column) -> Column:
    """Timestamp as ISO-8601 text with offset, microseconds kept."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def to_envelope(df: DataFrame, schema: StructType, partition: Column, offset: Column,
                timestamp: Column) -> DataFrame:
    """Keyed publish: key is the symbol, value the message fields as JSON."""
    body = F.to_json(F.struct(*schema.fieldNames()))
    return df.select(
        F.col("symbol").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def price_pipeline(messages: DataFrame, schema: StructType) -> DataFrame:
    """Raw price stream: parse, stamp, event time, validity, change, date parts."""
    return (messages.transform(parse_messages, schema)
            .transform(with_processing_time)
            .transform(with_event_time)
            .transform(valid_ticks)
            .transform(dated_ticks)
            .transform(with_price_change)
            .transform(with_date_parts))


def volume_pipeline(messages: DataFrame, schema: StructType) -> DataFrame:
    """Raw volume stream: as the price stream, without change."""
    return (messages.transform(parse_messages, schema)
            .transform(with_processing_time)
            .transform(with_event_time)
            .transform(valid_ticks)
            .transform(dated_ticks)
            .transform(with_date_parts))
