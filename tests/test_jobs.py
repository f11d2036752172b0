"""The jobs one after another, as a scheduler would run them."""

import os
import shutil
from datetime import date

from pyspark.sql import functions as F

from tickwell import jobs
from tickwell.operators import migration
from tickwell.operators.migration import with_day_parts
from tickwell.plans import frames as X
from tickwell.schemas import DAILY_VOLUMES, RAW_PRICES
from tickwell.session import staged
from tickwell.sources.days import read_days, replace_days
from tickwell.sources.messages import publish_messages

SF_DIR = "/root/testdata/sf0.001"


def test_from_topic_to_table(spark, folder, capsys):
    root, day = f"{folder}/root", "2024-01-15"
    on_day = F.to_date("timestamp") == F.lit(day).cast("date")
    publish_messages(X.price_messages(spark, SF_DIR).filter(on_day), f"{folder}/prices")
    publish_messages(X.volume_topic(spark, SF_DIR).filter(on_day), f"{folder}/volumes")
    n = X.quotes(spark, SF_DIR).filter(F.to_date("event_timestamp") == F.lit(day).cast("date")).count()

    def run(*args):
        return jobs.main([*args, "--root", root], spark)

    assert run("stream", "--mode", "all", "--checkpoints", f"{folder}/checkpoints", "--prices", f"{folder}/prices",
               "--volumes", f"{folder}/volumes", "--backing", "files", "--trigger", "once", "--state-partitions", "2") == 0
    assert run("quality", "--date", day) == 0
    assert run("quality", "--date", "2030-01-01") == 1
    assert "No records found" in capsys.readouterr().out
    assert run("daily", "--date", day) == 0
    volumes = read_days(spark, f"{root}/volumes/daily", with_day_parts(DAILY_VOLUMES), day)
    assert volumes.agg(F.sum("record_count")).first()[0] == n
    assert run("create-tables") == 0
    for _ in range(2):  # the second time adds nothing to the histories
        assert run("migrate", "--type", "all", "--start-date", day, "--record") == 0
    tables = {kind: migration.read_table(spark, kind, jobs.table_path(root, kind)) for kind in jobs.KINDS}
    assert tables["prices"].count() == n
    assert tables["volumes"].count() == n
    assert tables["daily"].agg(F.sum("record_count")).first()[0] == n
    travel = ("time-travel", "--table", "stock_prices", "--operation")
    assert run(*travel, "commits", "--output", f"{folder}/commits") == 0
    times = sorted(r.committed_at for r in spark.read.parquet(f"{folder}/commits").collect())
    assert len(times) == 1
    first = times[0]
    # a symbol's raw ticks go, and the day is migrated again
    raw = read_days(spark, f"{root}/prices/raw", RAW_PRICES, day)
    gone = raw.where("symbol = 'view'").count()
    assert 0 < gone < n
    kept = staged(raw.where("symbol <> 'view'"), "raw")
    shutil.rmtree(f"{root}/prices/raw")
    replace_days(kept, f"{root}/prices/raw", date(2024, 1, 15), date(2024, 1, 15))
    assert run("migrate", "--type", "prices", "--start-date", day, "--record") == 0
    assert run(*travel, "commits", "--output", f"{folder}/commits") == 0
    times = sorted(r.committed_at for r in spark.read.parquet(f"{folder}/commits").collect())
    assert len(times) == 2
    assert run(*travel, "as-of", "--output", f"{folder}/now") == 0
    assert spark.read.parquet(f"{folder}/now").count() == n - gone
    assert run(*travel, "states", "--output", f"{folder}/states") == 0
    assert sorted(r.rows_held for r in spark.read.parquet(f"{folder}/states").collect()) == [n - gone, n]
    assert run(*travel, "validity", "--output", f"{folder}/validity") == 0
    assert spark.read.parquet(f"{folder}/validity").where("valid_to IS NOT NULL").count() == gone
    assert run(*travel, "compare", "--timestamp", str(times[0]), "--timestamp-2", str(times[1])) == 0
    assert run(*travel, "as-of", "--timestamp", str(first), "--output", f"{folder}/as-of") == 0
    assert spark.read.parquet(f"{folder}/as-of").count() == n
    assert run(*travel, "symbol", "--symbol", "view", "--rows", "5") == 0
    assert run("sql", "--query", "SELECT symbol, sum(total_volume) AS v FROM daily_aggregates "
               f"WHERE date >= DATE '{day}' - INTERVAL '7' DAY GROUP BY symbol ORDER BY v DESC LIMIT 5") == 0
    assert run("optimize", "--date", day, "--retention-days", "0") == 0
    assert "skipped" not in capsys.readouterr().out
    assert migration.read_table(spark, "prices", jobs.table_path(root, "prices")).count() == n - gone
    assert run(*travel, "commits", "--output", f"{folder}/commits") == 0
    assert spark.read.parquet(f"{folder}/commits").count() == 1
    assert run("inventory") == 0
    assert "prices_daily" in capsys.readouterr().out
    assert run("consume", "--source", f"{folder}/prices", "--backing", "files", "--symbol", "view") == 0
    assert "purchase" not in capsys.readouterr().out


def test_a_broken_table_does_not_stop_the_others(spark, folder, capsys):
    root = f"{folder}/root"
    for kind in ("prices", "volumes"):
        table = jobs.table_path(root, kind)
        rows = spark.range(8).select(F.lit("A").alias("symbol"), F.col("id").cast("timestamp").alias("timestamp"), F.lit(1.0).alias("price"),
                                     F.lit("2024-01-15").cast("date").alias("date"))
        for _ in range(3):
            rows.coalesce(1).write.mode("append").partitionBy("date").parquet(table)
    bad = f"{jobs.table_path(root, 'prices')}/date=2024-01-15/part-bad.parquet"
    with open(bad, "w") as file:
        file.write("this is no Parquet")
    assert jobs.main(["optimize", "--root", root, "--date", "2024-01-15"], spark) == 1
    out = capsys.readouterr().out
    assert "|stock_prices |compact|failed|" in out and "|stock_volumes|compact|ok    |3           |1          |" in out
    assert migration.read_table(spark, "volumes", jobs.table_path(root, "volumes")).count() == 24
    os.remove(bad)
    assert jobs.main(["optimize", "--root", root, "--date", "2024-01-15", "--no-compaction"], spark) == 0
    assert "|off" in capsys.readouterr().out
    assert jobs.main(["optimize", "--root", root, "--date", "2024-01-15"], spark) == 0
    assert migration.read_table(spark, "prices", jobs.table_path(root, "prices")).count() == 24
