"""Upkeep of tables in plain Parquet: small files packed to a target size, replaced row versions dropped, all
tables side by side with a status each."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwell.operators import history
from tickwell.session import file_system, path_exists, sibling_session, staged
from tickwell.sources.days import replace_days

TARGET_BYTES = 128 << 20
#: A file below this share of the target is small.
SMALL = 0.75
_WORK = "_compact-"


@dataclass(frozen=True)
class Compaction:
    files_before: int
    files_rewritten: int
    files_written: int

    @property
    def files_after(self) -> int:
        return self.files_before - self.files_rewritten + self.files_written


def files(spark: SparkSession, path: str, schema: StructType, partitions: tuple[str, ...] = ("date",),
          where: str | None = None) -> DataFrame:
    """Partition columns, path and size of each file, from listing and footers."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    rows = rows if where is None else rows.where(where)
    return rows.select(*partitions, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()


def packed(listing: DataFrame, target: int, small_below: float, partitions: tuple[str, ...] = ("date",)) -> DataFrame:
    """The small files of each folder with the ``group`` they are packed into: consecutive files, largest first, until the
    target is full. A file without company stays as it is."""
    small = listing.where(F.col("size") < small_below)
    so_far = Window.partitionBy(*partitions).orderBy(F.desc("size"), "file").rowsBetween(Window.unboundedPreceding, 0)
    grouped = small.withColumn("group", F.floor((F.sum("size").over(so_far) - 1) / target))
    company = F.count("*").over(Window.partitionBy(*partitions, "group"))
    return grouped.withColumn("_n", company).where("_n > 1").drop("_n")


def compact(spark: SparkSession, path: str, schema: StructType, partitions: tuple[str, ...] = ("date",),
            target: int = TARGET_BYTES, small_below: float | None = None, where: str | None = None) -> Compaction:
    """Packs small files into files of about ``target`` bytes; files of a good size are neither read nor moved.

    New files are written whole to a hidden folder first, with a list of the files they replace. Then, group by
    group, they are moved in and the old ones removed. If a run dies in between, the next one finishes it
    before it looks for work. While a group is moved, readers may see its rows twice.
    """
    finish(spark, path)
    small_below = SMALL * target if small_below is None else small_below
    listing = staged(files(spark, path, schema, partitions, where), "files")
    chosen = packed(listing, target, small_below, partitions)
    work = f"{path}/{_WORK}{uuid4().hex}"
    chosen.write.parquet(f"{work}/old")
    old = spark.read.schema(chosen.schema).parquet(f"{work}/old")
    rewritten = old.count()
    if rewritten:
        rows = spark.read.schema(schema).option("basePath", path).parquet(path)
        # the size of a file is known before it is opened, so that good ones are not read
        rows = rows.where(F.col("_metadata.file_size") < small_below)
        rows = rows if where is None else rows.where(where)
        rows = rows.withColumn("_file", F.col("_metadata.file_path")).join(
            old.select(F.col("file").alias("_file"), F.col("group").alias("_group")), "_file").drop("_file")
        # a group is of bounded size and becomes one file
        rows.repartition(*partitions, "_group").write.partitionBy(*partitions, "_group").parquet(f"{work}/new")
    written = _publish(spark, path, work)
    return Compaction(listing.count(), rewritten, written)


def _below(spark: SparkSession, path: str) -> Iterator:
    fs, folder = file_system(spark, path)
    found = fs.listFiles(folder, True)
    while found.hasNext():
        yield found.next().getPath()


def _publish(spark: SparkSession, path: str, work: str) -> int:
    """Moves what is written under ``work`` into the folders of ``path`` and removes the old files."""
    fs, folder = file_system(spark, work)
    moved = 0
    if path_exists(spark, f"{work}/new"):
        root = file_system(spark, f"{work}/new")[1].toUri().getPath().rstrip("/")
        for file in list(_below(spark, f"{work}/new")):
            if not file.getName().startswith(("_", ".")):
                # a task gives the files of its groups the same name, in folders of their own
                group = file.getParent().getName().split("=")[1]
                inner = file.getParent().getParent().toUri().getPath()[len(root):]
                target = file_system(spark, f"{path}{inner}/packed-{group}-{file.getName()}")[1]
                if not fs.rename(file, target):
                    raise OSError(f"could not move {file} to {target}")
                moved += 1
    for row in spark.read.schema("file string").parquet(f"{work}/old").select("file").toLocalIterator():
        fs.delete(file_system(spark, row.file)[1], False)
    fs.delete(folder, True)
    return moved


def finish(spark: SparkSession, path: str) -> int:
    """Ends compactions that died: those whose files are complete are published, others are discarded."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return 0
    works = [s.getPath().toString() for s in fs.listStatus(folder) if s.getPath().getName().startswith(_WORK)]
    for work in works:
        # Spark marks a complete write; a publication that began has moved files, but not the mark
        if path_exists(spark, f"{work}/new/_SUCCESS"):
            _publish(spark, path, work)
        else:
            fs.delete(file_system(spark, work)[1], True)
    return len(works)


def expire(spark: SparkSession, path: str, schema: StructType, first: date, last: date, before: history.Moment,
           keys: tuple[str, ...]) -> None:
    """In the history at ``path``, row versions of some days that were replaced before a time go. Days of which nothing
    is left lose their folder."""
    rows = history.versions(spark, path, schema).where(F.col("date").between(F.lit(first), F.lit(last)))
    replace_days(staged(history.without_superseded(rows, before, keys), "kept"), path, first, last, ("date",))


# Several tables ----------------------------------------------------------------

STATUS = "table string, step string, status string, files_before long, files_after long, seconds double, error string"


@dataclass(frozen=True)
class Step:
    """One piece of upkeep of one table. ``work`` gets a session of its own and may return what a compaction did."""
    table: str
    name: str
    work: Callable[[SparkSession], Compaction | None]
    enabled: bool = True


def run_steps(spark: SparkSession, steps: list[Step], at_once: int = 4) -> DataFrame:
    """Runs the steps of different tables side by side, those of one table in order, and returns a status row for each.

    A failed step ends its table only: the later steps of that table are skipped, and other tables go
    on. Every table has a scheduler pool of its own, so a large one does not hold up the others."""
    by_table: dict[str, list[Step]] = {}
    for step in steps:
        by_table.setdefault(step.table, []).append(step)

    def one_table(own: list[Step]) -> list[tuple]:
        session, rows, failed = sibling_session(spark), [], False
        session.sparkContext.setLocalProperty("spark.scheduler.pool", own[0].table)
        try:
            for step in own:
                start, done, error = time.perf_counter(), None, None
                status = "off" if not step.enabled else "skipped" if failed else "ok"
                if status == "ok":
                    try:
                        done = step.work(session)
                    except Exception as e:  # a status, not an end: the other tables go on
                        status, error, failed = "failed", f"{type(e).__name__}: {e}"[:2000], True
                rows.append((step.table, step.name, status, done and done.files_before, done and done.files_after,
                             time.perf_counter() - start, error))
        finally:
            session.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return rows

    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(one_table), own) for own in by_table.values()]
        rows = [row for job in running for row in job.result()]
    return spark.createDataFrame(rows, STATUS)
