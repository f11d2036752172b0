"""What the operators of this package share: tables, staging, group counts."""

from __future__ import annotations

import gc
import math
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.session import file_system, setting
from tickwell.session import staged as written

__all__ = ["collected", "discard", "groups_for", "rows_of", "table", "staged", "text_or_empty", "width"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder once and read back, well compressed. Python workers get small
    Arrow batches meanwhile, which bounds what a batch of long texts takes in each of them."""
    spark = df.sparkSession
    with (setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"),
          setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "16m"),
          setting(spark, "spark.sql.parquet.compression.codec", "zstd")):
        return written(df, label)


def discard(*frames: DataFrame) -> None:
    """Removes staged frames that nothing will read again."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            fs, folder = file_system(df.sparkSession, path)
            fs.delete(folder, True)


def collected(spark: SparkSession) -> None:
    """Has the driver's garbage collected, so that the shuffle files of finished steps, whose
    frames are gone, are removed now and not some time later. Python lets go of its Java objects
    in a thread of its own, hence the pause."""
    for _ in range(2):
        gc.collect()
        time.sleep(1.5)
        spark.sparkContext._jvm.System.gc()


def width(spark: SparkSession) -> int:
    """The shuffle width the cluster is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def groups_for(items: int, per_group: int) -> int:
    """How many hash groups keep each near ``per_group`` items, however many items there are."""
    return max(1, math.ceil(items / per_group))


def rows_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that ``wanted`` names by doc_id and text_key
    (xxhash64 of the text); of rows that repeat both, one. The join shuffles at every size:
    how many rows are wanted grows with the input."""
    names = wanted.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__wanted")).distinct().hint("merge")
    keyed = docs.withColumn("__key", F.xxhash64(text_or_empty()))
    found = keyed.join(names, (F.col("__key") == F.col("__wanted")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return found.dropDuplicates(["__key", "doc_id"]).drop("__key")
