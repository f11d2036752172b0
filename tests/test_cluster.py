"""The shared folder in a session whose executors are processes of their own."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
from pyspark.sql import SparkSession

how, folder = sys.argv[1:]
builder = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC") \\
    .config("spark.sql.warehouse.dir", folder + "/warehouse")
if how == "plain":
    builder = builder.config("spark.checkpoint.dir", folder + "/shared")
spark = builder.getOrCreate()
if how == "context":
    spark.sparkContext.setCheckpointDir(folder + "/set")
from tickwell import session
from tickwell.plans.catalog import QUERIES

for name in ("alert_low_ingestion", "latest_price_per_symbol"):  # a checkpoint, a staged table
    print("ROWS", name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
print("AT", session.shared_dir(spark), "MADE", session.release(spark))
spark.stop()
"""


@pytest.mark.parametrize("how, within", [("plain", "shared"), ("context", "set"), ("none", "warehouse/_tickwell")])
def test_shared_folder_of_a_cluster_session(folder, how, within):
    # SPARK_CONF_DIR: a folder without defaults, which may name a checkpoint folder
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": folder, "PYSPARK_SUBMIT_ARGS": "pyspark-shell", "SPARK_LOCAL_DIRS": f"{folder}/local"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, how, folder], env=env, cwd=folder, capture_output=True, text=True, timeout=180)
    said = [x.split() for x in done.stdout.splitlines() if x.startswith(("ROWS", "AT"))]
    assert [x[:3] for x in said[:2]] == [["ROWS", "alert_low_ingestion", "1"], ["ROWS", "latest_price_per_symbol", "5"]], done.stderr[-2000:]
    assert said[2][1].startswith(f"file:{folder}/{within}") and int(said[2][3]) > 0
