"""Connected components of links, by alternating large and small stars on DataFrames.

Every round replaces links by links to smaller nodes; the number of rounds grows with the
logarithm of a component's diameter. A node with very many links costs one partial row for
each task in the aggregates, and in the joins it is a skewed key that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import staged


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the links (a, b).

    Links may repeat, in either direction; links of a node to itself and with NULL are ignored."""
    links = staged(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
                   "links")
    before = _state(links)
    while before[0]:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.explode(F.array(
            F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        links = staged(small.select("e.*").where("hi <> lo").distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
