"""Running totals over an order of any length, also within one key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.operators.lookup import settled
from tickwell.session import cut, staged


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, name: str,
                  large: bool = True) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over this and all earlier rows of the key.

    A window by key would sort all rows of a hot key in one task. Here rows are
    range-partitioned by key and order, so a long key spreads over many slices;
    each slice sums its own rows and adds the total of the key's earlier slices.
    ``order`` must be unique within the key.

    Staging fixes which slice a row belongs to, since the slice totals and the rows
    are read separately. It writes the given columns once: select only what is
    needed before calling. ``large=False`` suits aggregates: a checkpoint instead.
    """
    by = [*keys, *order]
    sliced = df.repartitionByRange(*by).withColumn("_slice", F.spark_partition_id())
    sliced = staged(sliced, "slices") if large else cut(sliced)

    # One row per key and slice: at most (number of keys + number of slices), and
    # without keys no more than there are slices.
    totals = sliced.groupBy(*keys, "_slice").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_at_{c}") for c in (*keys, "_slice")],
                            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))

    within = (Window.partitionBy(*keys, "_slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    same = [F.col("_slice") == F.col("_at__slice")]
    same += [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in keys]  # NULL is a key too
    return (sliced.withColumn("_local", F.sum(value).over(within))
            .join(settled(offsets) if keys else F.broadcast(offsets), same)
            .withColumn(name, F.coalesce("_local", F.lit(0)) + F.col("_offset"))
            .select(*df.columns, name))


def cumulative_volume(ticks: DataFrame) -> DataFrame:
    """Running volume per symbol: a counter that only grows."""
    rows = ticks.select("tick_id", "symbol", "event_timestamp", "volume")
    return running_total(rows, ["symbol"], ["event_timestamp", "tick_id"], "volume",
                         "cumulative_volume")
