"""Queries that write to the shared folder, on a cluster session whose checkpoint folder has no scheme, beside their SQL."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import json, sys
from pyspark.sql import SparkSession

import duckdb
from check import TABLES, compare
from tickwell import session

folder, sf_dir = sys.argv[1:3]
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC") \\
    .config("spark.sql.warehouse.dir", folder + "/warehouse").config("spark.checkpoint.dir", folder + "/shared").getOrCreate()
con = duckdb.connect()
con.execute("SET TimeZone = 'UTC'")
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
for name in sys.argv[3:]:
    try:
        said, _, same = compare(spark, con, sf_dir, name)
    except Exception as error:
        said, same = f"{type(error).__name__}: {error}", False
    print("FOUND", json.dumps([name, same, said]), flush=True)
session.release(spark)
spark.stop()
"""

NAMES = [
    "alert_error_rate",
    "alert_error_rate_fires",
    "alert_error_rate_hourly",
    "alert_low_ingestion",
    "alert_low_ingestion_silence",
    "alert_outage_until_now",
    "backfill_daily",
    "backfill_daily_volumes",
    "compact_preserves_rows",
    "compact_small_files",
    "consumer_lag_series",
    "create_tables",
    "cumulative_volume",
    "daily_overwrite_idempotent",
    "daily_today",
    "dq_stored_day",
    "daily_prices",
    "drain_topic_messages",
    "expire_snapshots",
    "latest_price_per_symbol",
    "latest_prices",
    "migrate_daily_aggregates",
]


@pytest.fixture(scope="module")
def found(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cluster"))
    # SPARK_CONF_DIR: a folder without defaults, which may name a checkpoint folder
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": folder, "PYSPARK_SUBMIT_ARGS": "pyspark-shell", "SPARK_LOCAL_DIRS": f"{folder}/local",
                        "SPARK_WORKER_DIR": f"{folder}/work"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, folder, "/root/testdata/sf0.001", *NAMES], env=env, cwd=folder,
                          capture_output=True, text=True, timeout=600)
    said = [json.loads(x.removeprefix("FOUND ")) for x in done.stdout.splitlines() if x.startswith("FOUND ")]
    assert said, done.stderr[-2000:]
    return {name: (same, text) for name, same, text in said}


@pytest.mark.parametrize("name", NAMES)
def test_ends_with_the_rows_of_its_sql(found, name):
    assert found[name][0], found[name][1]
