"""Shared storage of a session: where checkpoints and intermediate tables go."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, visible to every executor.

    As in Spark, a folder without scheme is one of the default file system; on a cluster it is
    made a full URI here, so that all nodes mean the same. ``file:`` folders are taken as mounted on
    all of them. Without the setting, the checkpoint folder set on the context counts; without that, a
    cluster session uses a hidden folder of the warehouse, which its nodes share for tables, too,
    and a local one a fresh temporary folder.
    """
    sc = spark.sparkContext
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return (configured if local else _full(spark, configured)).rstrip("/")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickwell-") if local
                            else _full(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tickwell"))
    return sc.getCheckpointDir().rstrip("/")


def _full(spark: SparkSession, path: str) -> str:
    """The path with its file system."""
    fs, hadoop_path = file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString()


#: Intermediate folders of this process, by the id of their application.
_MADE: dict[str, list[str]] = {}


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; nothing is created yet. ``release`` removes it."""
    path = f"{shared_dir(spark)}/tickwell/{label}-{uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Catalog tables over such folders.
_TABLES: dict[str, list[str]] = {}


def fresh_table(spark: SparkSession, label: str) -> str:
    """A new name for a catalog table; ``release`` drops it."""
    name = f"tickwell_{label}_{uuid4().hex}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def release(spark: SparkSession) -> int:
    """Removes the intermediate folders and tables made so far, and returns how many folders there were.

    To be called when the results that were built on them have been used; jobs do so at
    their end. Checkpoints go with their frames if spark.cleaner.referenceTracking.cleanCheckpoints
    is set, which a cluster should do.
    """
    for name in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        fs, hadoop_path = file_system(spark, path)
        fs.delete(hadoop_path, True)
    return len(paths)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes a large intermediate result to the shared folder once and reads it back:
    as durable as a checkpoint, and readers take only the columns they need."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of one job; the old value comes back after it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def folders_in_parallel(spark: SparkSession):
    """For writes into partition folders after a ``rebalance``: small folders, too, are
    spread over tasks. A file costs far more than its few bytes, and since the rows of
    a folder are in one shuffle partition, merging those would not save files."""
    return setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of a URI, for existence checks and deletion."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def sibling_session(spark: SparkSession) -> SparkSession:
    """A session with settings of its own, for work beside the caller's. It has the caller's time zone
    and shuffle width, and shares the context and intermediate folders."""
    sibling = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        sibling.conf.set(key, spark.conf.get(key))
    return sibling


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session whose shuffle width fits state stores.

    A stateful query fixes its number of state partitions at first start, so the
    number is chosen per stream and not taken from the batch default. The sibling
    shares the Spark context and leaves the caller's settings as they are.
    """
    sibling = sibling_session(spark)
    width = state_partitions or spark.sparkContext.defaultParallelism
    sibling.conf.set("spark.sql.shuffle.partitions", str(width))
    # State grows with symbols x open windows: keep it off the Java heap and
    # upload changes only.
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling
