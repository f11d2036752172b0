"""Date-partitioned Parquet: ``root/year=Y/month=M/day=D/...``."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwell.schemas import DAY_PARTITIONS
from tickwell.session import file_system, folders_in_parallel, path_exists


def as_day(value: str | date | None, spark: SparkSession) -> date:
    """A calendar day; ``None`` means yesterday, as the daily jobs default to. Today is the
    session's, in its time zone, like the dates of folders."""
    if value is None:
        return spark.range(1).select(F.date_sub(F.current_date(), 1)).first()[0]
    return value if isinstance(value, date) else date.fromisoformat(value)


def _is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_days(spark: SparkSession, root: str, schema: StructType,
              start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Rows of the days ``start`` to ``end``, both included.

    The wanted day folders are named in the path, so only they are listed, however
    many other days, hours and symbols the dataset holds. Days that do not exist
    contribute nothing, and an absent dataset gives an empty frame of ``schema``.
    Any other read error is raised.

    Output of a stream is read through the log of its sink, which lists committed
    files only: naming folders would bypass it and see files of failed batches.
    """
    first = as_day(start, spark)
    last = as_day(end, spark) if end is not None else first
    span = (last - first).days + 1
    if span <= 0:
        raise ValueError(f"empty date range {first} to {last}")
    reader = spark.read.schema(schema).option("basePath", root)
    try:
        if not path_exists(spark, f"{root}/_spark_metadata"):
            days = (first + timedelta(days=i) for i in range(span))
            names = ",".join(f"year={d.year}/month={d.month}/day={d.day}" for d in days)
            return reader.parquet(f"{root}/{{{names}}}").select(*schema.fieldNames())
        df = reader.parquet(root).select(*schema.fieldNames())
    except AnalysisException as error:
        if _is_missing_path(error):
            return spark.createDataFrame([], schema)
        raise
    day = F.make_date("year", "month", "day")
    return df.where(F.col("year").between(first.year, last.year) & day.between(F.lit(first), F.lit(last)))


def write_days(df: DataFrame, root: str, partitions=DAY_PARTITIONS, mode: str = "append") -> None:
    """Write by partition folder.

    Rebalancing gathers the rows of a folder into few files of even size and lets
    AQE split a folder that holds far more rows than the others over many tasks.
    """
    with folders_in_parallel(df.sparkSession):
        (df.hint("rebalance", *partitions).write.mode(mode)
         .partitionBy(*partitions).parquet(root))


def overwrite_days(df: DataFrame, root: str, partitions=DAY_PARTITIONS) -> None:
    """Replace exactly the partitions present in ``df``; a re-run changes nothing."""
    with folders_in_parallel(df.sparkSession):
        (df.hint("rebalance", *partitions).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(root))


def _folder(day: date, partitions: tuple[str, ...]) -> str:
    if "date" in partitions:
        return f"date={day.isoformat()}"
    return f"year={day.year}/month={day.month}/day={day.day}"


def replace_days(df: DataFrame, root: str, first: date, last: date, partitions=DAY_PARTITIONS) -> int:
    """Replace every day of a range: those in ``df`` by its rows, the others by nothing. Returns how
    many rows were written.

    The write itself observes which days there are, as one bit for each day of the range, and counts the
    rows, so ``df`` is computed once. Folders of days without rows go after it; if a run dies before that,
    doing it again gives the same result.
    """
    spark = df.sparkSession
    day = F.col("date") if "date" in partitions else F.make_date("year", "month", "day")
    number = F.datediff(day, F.lit(first))
    # a bitmap has 32,768 bits; a longer range takes several
    size = 32_768
    maps = [F.bitmap_construct_agg(F.when((number >= k) & (number < k + size), (number - k).cast("long"))).alias(f"days{k}")
            for k in range(0, (last - first).days + 1, size)]
    seen = Observation()
    overwrite_days(df.observe(seen, F.count(F.lit(1)).alias("rows"), *maps), root, partitions)
    # of a frame that is known to be empty, nothing is observed
    found = seen.get if seen._jo.getRow().size() else {"rows": 0}
    for k in range((last - first).days + 1):
        bits = found.get(f"days{k - k % size}")
        if bits is None or not bits[k % size // 8] >> (k % 8) & 1:
            fs, path = file_system(spark, f"{root}/{_folder(first + timedelta(days=k), partitions)}")
            if fs.exists(path):
                fs.delete(path, True)
    return found["rows"]


def partition_inventory(spark: SparkSession, root: str, schema: StructType,
                        partitions=DAY_PARTITIONS) -> DataFrame:
    """Files, rows and bytes per partition, from file metadata and footers only."""
    files = (spark.read.schema(schema).option("basePath", root).parquet(root)
             .groupBy(*partitions, F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
             .agg(F.count("*").alias("rows")))
    return (files.groupBy(*partitions)
            .agg(F.count("*").alias("files"), F.sum("rows").alias("rows"),
                 F.sum("file_size").alias("bytes")))
