"""Join of many rows with a derived table whose size is not known in advance."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickwell.session import staged


def settled(lookup: DataFrame) -> DataFrame:
    """Computes a lookup table once, as Parquet in the shared folder.

    The planner can only guess the size of an aggregate. Of written files it knows the
    bytes, and broadcasts the table if they are within spark.sql.autoBroadcastJoinThreshold;
    beyond it the table joins by shuffle, where AQE splits hot keys.
    """
    return staged(lookup, "lookup")


def lookup_join(fact: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Joins ``fact`` with an aggregate of it, or any frame of unique keys."""
    return fact.join(settled(lookup), on, how)
