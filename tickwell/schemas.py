"""Fixed schemas of messages, raw ticks and tables."""

from pyspark.sql.types import (BinaryType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

# The columns of messages and tables. Volume is a long: the daily volume of
# a liquid symbol does not fit an int, and JSON parsing turns an overflowing int into NULL.
ENVELOPE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

PRICE_MESSAGE = StructType([
    StructField("symbol", StringType(), False),
    StructField("timestamp", StringType(), False),
    StructField("price", DoubleType(), False),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("volume", LongType()),
    StructField("previous_close", DoubleType()),
    StructField("market_cap", DoubleType()),
    StructField("currency", StringType()),
])

VOLUME_MESSAGE = StructType([
    StructField("symbol", StringType(), False),
    StructField("timestamp", StringType(), False),
    StructField("volume", LongType(), False),
    StructField("price", DoubleType()),
])

PRICES_TABLE = StructType([
    StructField("symbol", StringType(), False),
    StructField("timestamp", TimestampType(), False),
    StructField("date", DateType(), False),
    StructField("price", DoubleType(), False),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("volume", LongType()),
    StructField("previous_close", DoubleType()),
    StructField("price_change", DoubleType()),
    StructField("price_change_pct", DoubleType()),
    StructField("market_cap", DoubleType()),
    StructField("currency", StringType()),
])

VOLUMES_TABLE = StructType([
    StructField("symbol", StringType(), False),
    StructField("timestamp", TimestampType(), False),
    StructField("date", DateType(), False),
    StructField("volume", LongType(), False),
    StructField("price", DoubleType()),
])

DAILY_TABLE = StructType([
    StructField("symbol", StringType(), False),
    StructField("date", DateType(), False),
    StructField("avg_price", DoubleType()),
    StructField("max_price", DoubleType()),
    StructField("min_price", DoubleType()),
    StructField("max_high", DoubleType()),
    StructField("min_low", DoubleType()),
    StructField("total_volume", LongType()),
    StructField("record_count", LongType()),
    StructField("avg_price_change", DoubleType()),
    StructField("avg_price_change_pct", DoubleType()),
    StructField("price_range", DoubleType()),
    StructField("price_range_pct", DoubleType()),
])

DAILY_VOLUMES = StructType([
    StructField("symbol", StringType(), False),
    StructField("date", DateType(), False),
    StructField("total_volume", LongType()),
    StructField("avg_volume", DoubleType()),
    StructField("max_volume", LongType()),
    StructField("min_volume", LongType()),
    StructField("avg_price", DoubleType()),
    StructField("record_count", LongType()),
])

_LINEAGE = [
    StructField("kafka_key", StringType()),
    StructField("kafka_partition", IntegerType()),
    StructField("kafka_offset", LongType()),
    StructField("kafka_timestamp", TimestampType()),
]
_TIMES = [
    StructField("processing_timestamp", TimestampType()),
    StructField("event_timestamp", TimestampType()),
]
_CHANGES = [
    StructField("price_change", DoubleType()),
    StructField("price_change_pct", DoubleType()),
]
_DATE_PARTS = [
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("hour", IntegerType()),
]

# What the raw streams write.
RAW_PRICES = StructType(_LINEAGE + PRICE_MESSAGE.fields + _TIMES + _CHANGES + _DATE_PARTS)
RAW_VOLUMES = StructType(_LINEAGE + VOLUME_MESSAGE.fields + _TIMES + _DATE_PARTS)
# Messages that cannot become ticks, by the day they came in; any field may be missing.
REJECTS = StructType(_LINEAGE + [
    StructField("symbol", StringType()),
    StructField("timestamp", StringType()),
    StructField("volume", LongType()),
    StructField("price", DoubleType()),
] + _TIMES + [StructField("reason", StringType())] + _DATE_PARTS[:3])

RAW_PARTITIONS = ("year", "month", "day", "hour", "symbol")
DAY_PARTITIONS = ("year", "month", "day")
TABLE_PARTITIONS = ("symbol", "date")
