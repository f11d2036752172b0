"""Which datasets exist and how large they are. Folders are listed by tasks, level by level: a task
returns the sums over the files of its folders and the folders below, so no list of files is ever put
together, on the driver or elsewhere."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.session import file_system, path_exists, staged

_FOUND = "name string, folder string, files long, bytes long"


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One level: a row for each folder with the sums over its files, and a row for each folder below."""
    for batch in batches:
        rows = []
        for name, folder in zip(batch["name"], batch["folder"]):
            system, path = fs.FileSystem.from_uri(folder)
            files = size = 0
            for entry in system.get_file_info(fs.FileSelector(path)):
                if entry.base_name.startswith(("_", ".")):
                    continue  # as Spark's own readers do
                if entry.type == fs.FileType.Directory:
                    rows.append((name, f"{folder.rstrip('/')}/{entry.base_name}", None, None))
                else:
                    files, size = files + 1, size + entry.size
            rows.append((name, None, files, size))
        yield pd.DataFrame(rows, columns=["name", "folder", "files", "bytes"]).astype({"files": "Int64", "bytes": "Int64"})


def _readable_by_tasks(uri: str) -> bool:
    try:
        fs.FileSystem.from_uri(uri)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ValueError):
        return False


def path_inventory(spark: SparkSession, named_paths: dict[str, str]) -> DataFrame:
    """name, path, exists, files and bytes of each dataset, hidden files and folders left out.

    There are as many rounds as folders are nested. A file system that tasks have no reader for
    is asked for its own summary of the path instead, which counts hidden files, too."""
    known, rows = [], []
    for name, path in named_paths.items():
        there = path_exists(spark, path)
        uri = file_system(spark, path)[0].makeQualified(file_system(spark, path)[1]).toString() if there else path
        uri = uri if "://" in uri else uri.replace("file:/", "file:///", 1)
        if there and not _readable_by_tasks(uri):
            system, folder = file_system(spark, path)
            summary = system.getContentSummary(folder)
            known.append((name, path, True, summary.getFileCount(), summary.getLength()))
        else:
            known.append((name, path, there, 0, 0))
            rows += [(name, uri)] if there else []
    datasets = spark.createDataFrame(known, "name string, path string, exists boolean, files long, bytes long")
    sums, level = [], spark.createDataFrame(rows, "name string, folder string")
    while rows:
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = staged(level.repartition(width).mapInPandas(_listed, _FOUND), "inventory")
        sums.append(found.where("folder IS NULL").groupBy("name").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes")))
        level = found.where("folder IS NOT NULL").select("name", "folder")
        if level.isEmpty():
            break
    if not sums:
        return datasets
    total = sums[0]
    for one in sums[1:]:
        total = total.unionAll(one)
    total = total.groupBy(F.col("name").alias("of")).agg(F.sum("files").alias("more"), F.sum("bytes").alias("size"))
    return datasets.join(total, F.col("name") == F.col("of"), "left").select(
        "name", "path", "exists", (F.col("files") + F.coalesce("more", F.lit(0))).alias("files"),
        (F.col("bytes") + F.coalesce("size", F.lit(0))).alias("bytes"))
