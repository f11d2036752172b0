"""Cleaning of parsed ticks: valid rows once each, the rest to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.session import staged

KEY = ("symbol", "event_timestamp")


def reject_reason() -> Column:
    """Why a parsed tick is unusable; NULL for a good one."""
    body = ("symbol", "timestamp", "price")
    return (F.when(F.coalesce(*[F.col(c).cast("string") for c in body]).isNull(), "malformed")
            .when(F.col("symbol").isNull(), "missing symbol")
            .when(F.col("price").isNull(), "missing price")
            .when(F.col("price") <= 0, "non-positive price")
            .when(F.col("event_timestamp").isNull(), "unreadable time"))


def _place() -> Column:
    """One number that orders deliveries by offset, then partition."""
    return F.col("kafka_offset").cast("decimal(38,0)") * 2 ** 31 + F.col("kafka_partition")


def judged(parsed: DataFrame) -> DataFrame:
    """Every parsed tick with its ``reason``: NULL for the tick that counts, "duplicate" for
    copies of one symbol and event time that are not the latest offset.

    The latest offset of a key is a hash aggregate with partial aggregation, so a tick
    delivered very often costs one partial row for each task; equal offsets are told apart
    by the partition. The parse is staged once, and both results are read from it.
    """
    rows = staged(parsed.withColumn("reason", reject_reason()), "judged")
    latest = rows.where("reason is null").groupBy(*KEY).agg(F.max(_place()).alias("_latest"))
    latest = latest.select(*[F.col(c).alias(f"_{c}") for c in KEY], "_latest")
    on = [F.col(c) == F.col(f"_{c}") for c in KEY]
    duplicate = F.col("reason").isNull() & (_place() < F.col("_latest"))
    return rows.join(latest, on, "left").select(
        *parsed.columns, F.when(duplicate, "duplicate").otherwise(F.col("reason")).alias("reason"))


def clean_ticks(parsed: DataFrame) -> DataFrame:
    """Valid ticks, one per symbol and event time: the one with the latest offset. Only what counts is
    wanted here, so one aggregate over one read does it, and nothing is staged or joined."""
    rest = [c for c in parsed.columns if c not in KEY]
    newest = parsed.where(reject_reason().isNull()).groupBy(*KEY).agg(F.max_by(F.struct(*rest), _place()).alias("_row"))
    return newest.select(*[F.col(c) if c in KEY else F.col(f"_row.{c}").alias(c) for c in parsed.columns])


def quarantine(parsed: DataFrame) -> DataFrame:
    """Every row that ``clean_ticks`` leaves out, with the reason."""
    return judged(parsed).where("reason is not null")
