"""Catalog tables: the three fixed tables as partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickwell.schemas import DAILY_TABLE, PRICES_TABLE, TABLE_PARTITIONS, VOLUMES_TABLE
from tickwell.session import folders_in_parallel

TABLES = {
    "stock_prices": PRICES_TABLE,
    "stock_volumes": VOLUMES_TABLE,
    "daily_aggregates": DAILY_TABLE,
}


def create_table(spark: SparkSession, name: str, schema: StructType, location: str,
                 partitions=TABLE_PARTITIONS) -> None:
    """Create the table if it is absent."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet "
              f"OPTIONS (compression 'snappy') PARTITIONED BY ({', '.join(partitions)}) "
              f"LOCATION '{location}'")


def create_all_tables(spark: SparkSession, database: str, warehouse: str) -> list[str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{warehouse}'")
    names = []
    for name, schema in TABLES.items():
        create_table(spark, f"{database}.{name}", schema, f"{warehouse}/{name}")
        names.append(f"{database}.{name}")
    return names


def append_to_table(df: DataFrame, name: str, partitions=TABLE_PARTITIONS) -> None:
    """Append by column name; partition columns may stand anywhere in ``df``."""
    target = df.sparkSession.table(name).columns
    with folders_in_parallel(df.sparkSession):
        df.select(*target).hint("rebalance", *partitions).write.insertInto(name)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Makes frames, such as the current state of versioned tables, known to SQL by name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def row_count(df: DataFrame) -> DataFrame:
    return df.groupBy().count().withColumnRenamed("count", "row_count")
