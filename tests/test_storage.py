import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell import session
from tickwell.functions.ticks import with_date_parts
from tickwell.operators import history as H
from tickwell.operators import maintenance as M2
from tickwell.operators import migration as M
from tickwell.schemas import RAW_VOLUMES
from tickwell.sources import days as S
from tickwell.sources import tables as C
from tickwell.sources.inventory import path_inventory

DAYS = T.StructType([T.StructField("id", T.LongType()), T.StructField("symbol", T.StringType()),
                     *[T.StructField(c, T.IntegerType()) for c in S.DAY_PARTITIONS]])


def day_rows(spark, first="2024-01-30", n=5):
    d = F.date_add(F.lit(first).cast("date"), (F.col("id") % n).cast("int"))
    return spark.range(20).select("id", F.lit("007").alias("symbol"), F.year(d).alias("year"), F.month(d).alias("month"),
                                  F.dayofmonth(d).alias("day"))


def test_read_one_day_and_a_range(spark, folder):
    S.write_days(day_rows(spark), folder)
    one = S.read_days(spark, folder, DAYS, "2024-02-01")
    assert {r.id for r in one.collect()} == {2, 7, 12, 17}
    assert one.schema == DAYS and one.first().symbol == "007"
    assert all("month=2/day=1" in f for f in one.inputFiles())
    assert S.read_days(spark, folder, DAYS, "2024-01-31", "2024-02-02").count() == 12
    assert S.read_days(spark, folder, DAYS, date(2020, 1, 1), "2030-01-01").count() == 20
    with pytest.raises(ValueError):
        S.read_days(spark, folder, DAYS, "2024-02-02", "2024-02-01")


def test_missing_day_and_missing_dataset(spark, folder):
    S.write_days(day_rows(spark), folder)
    for root in (folder, f"{folder}/nowhere"):
        df = S.read_days(spark, root, DAYS, "2025-01-01")
        assert df.count() == 0 and df.schema == DAYS


def test_other_read_errors_are_raised(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        S.read_days(spark, "nosuchscheme://host/raw", DAYS, "2024-01-01")


def test_overwrite_replaces_only_given_days(spark, folder):
    S.overwrite_days(day_rows(spark), folder)
    again = day_rows(spark).filter("day = 1").withColumn("id", F.col("id") + 100)
    for _ in range(2):
        S.overwrite_days(again, folder)
    ids = sorted(r.id for r in spark.read.schema(DAYS).parquet(folder).collect())
    assert ids == sorted([i for i in range(20) if i % 5 != 2] + [102, 107, 112, 117])


def test_inventory(spark, folder):
    S.write_days(day_rows(spark), folder)
    got = {r.day: (r.rows, r.files) for r in S.partition_inventory(spark, folder, DAYS).collect()}
    assert set(got) == {30, 31, 1, 2, 3} and all(rows == 4 and files >= 1 for rows, files in got.values())
    found = {r.name: (r.exists, r.files, r.bytes) for r in path_inventory(spark, {"a": folder, "b": f"{folder}/x", "c": f"file://{folder}"}).collect()}
    sizes = [os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(folder) for f in fs if not f.startswith(("_", "."))]
    assert found == {"a": (True, len(sizes), sum(sizes)), "b": (False, 0, 0), "c": (True, len(sizes), sum(sizes))}
    empty = f"{folder}/empty/below"
    os.makedirs(empty)
    assert [tuple(r) for r in path_inventory(spark, {"e": empty}).collect()] == [("e", empty, True, 0, 0)]


def test_catalog_tables_once(spark, folder):
    for _ in range(2):
        names = C.create_all_tables(spark, "market_test", folder)
    assert names == [f"market_test.{t}" for t in ("stock_prices", "stock_volumes", "daily_aggregates")]
    columns = spark.catalog.listColumns("market_test.stock_volumes")
    assert [c.name for c in columns if c.isPartition] == ["symbol", "date"]
    row = spark.createDataFrame([(1.5, date(2024, 1, 1), "A", 7, datetime(2024, 1, 1, 5))],
                                "price double, date date, symbol string, volume bigint, timestamp timestamp")
    C.append_to_table(row, "market_test.stock_volumes")
    C.append_to_table(row, "market_test.stock_volumes")
    got = spark.table("market_test.stock_volumes").collect()
    assert [(r.symbol, r.date, r.volume, r.price) for r in got] == [("A", date(2024, 1, 1), 7, 1.5)] * 2


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_dir(spark, "x") != session.fresh_dir(spark, "x")


def test_setting_is_restored(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with session.setting(spark, key, "1234"):
        assert spark.conf.get(key).rstrip("b") == "1234"
    assert spark.conf.get(key) == before


# Row versions in plain Parquet --------------------------------------------------

SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
                       T.StructField("timestamp", T.TimestampType()), T.StructField("price", T.DoubleType())])


def rows(spark, *items):
    return spark.createDataFrame([(s, date.fromisoformat(d), datetime.fromisoformat(d), p) for s, d, p in items], SCHEMA)


def bag(df):
    return sorted((r.symbol, str(r.date), r.price) for r in df.collect())


A1, A2, B1 = ("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0), ("B", "2024-01-01", 3.0)
A1_NEW = ("A", "2024-01-01", 1.5)


@pytest.fixture
def versions(spark, folder):
    path = f"{folder}/history"
    H.record(rows(spark, A1, B1), path, "2024-01-10 00:00:00")
    H.record(rows(spark, A2), path, "2024-01-20 00:00:00")
    H.record(rows(spark, A1_NEW), path, "2024-01-30 00:00:00")
    H.record(rows(spark, B1), path, "2024-02-01 00:00:00", deleted=True)
    return H.versions(spark, path, SCHEMA)


def test_state_as_of_a_time(spark, versions):
    assert bag(H.as_of(versions)) == sorted([A1_NEW, A2])
    assert bag(H.as_of(versions, "2024-01-30 00:00:00")) == sorted([A1_NEW, A2, B1])
    assert bag(H.as_of(versions, "2024-01-29 23:59:59")) == sorted([A1, A2, B1])
    assert bag(H.as_of(versions, "2024-01-01 00:00:00")) == []
    assert set(H.as_of(versions).columns) == set(SCHEMA.fieldNames())
    assert bag(H.symbol_as_of(versions, "A", "2024-01-25 00:00:00", n=1)) == [A2]
    assert [r.rows for r in H.commits(versions).orderBy("committed_at").collect()] == [2, 1, 1, 1]


def test_comparison_pairs_nothing(spark, folder):
    path = f"{folder}/copies"
    H.record(rows(spark, *[A1] * 50, A2, B1), path, "2024-01-10 00:00:00")
    H.record(rows(spark, *[A1_NEW] * 40), path, "2024-01-20 00:00:00")
    got = H.compare(H.versions(spark, path, SCHEMA), "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    assert {(r.symbol, str(r.timestamp.date())): (r.price_change, r.copies_v1, r.copies_v2) for r in got.collect()} == {
        ("A", "2024-01-01"): (0.5, 50, 40), ("A", "2024-01-02"): (0.0, 1, 1), ("B", "2024-01-01"): (0.0, 1, 1)}


def test_superseded_versions_go(spark, versions, folder):
    kept = H.without_superseded(versions, "2024-01-30 00:00:00")
    assert kept.count() == 4
    assert bag(H.as_of(kept, "2024-01-30 00:00:00")) == sorted([A1_NEW, A2, B1])
    H.rewrite(kept, f"{folder}/history")
    again = H.versions(spark, f"{folder}/history", SCHEMA)
    assert again.count() == 4 and bag(H.as_of(again)) == sorted([A1_NEW, A2])


def test_replacing_days_clears_those_without_rows(spark, folder):
    first, last = date(2024, 1, 1), date(2024, 1, 3)
    S.replace_days(rows(spark, A1, A2), folder, first, last, ("date",))
    S.replace_days(rows(spark, ("C", "2024-01-03", 4.0)), folder, date(2024, 1, 2), last, ("date",))
    assert bag(spark.read.schema(SCHEMA).parquet(folder)) == [A1, ("C", "2024-01-03", 4.0)]
    S.replace_days(rows(spark), folder, date(2024, 1, 3), last, ("date",))
    assert bag(spark.read.schema(SCHEMA).parquet(folder)) == [A1]


def test_migration_loses_no_row_across_zones(spark, folder):
    """Stored by a session in UTC, moved by one in New York: the folder says the day."""
    times = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)
    raw = spark.range(24).select("id", F.lit("A").alias("symbol"), times.alias("event_timestamp"), F.lit(1.0).alias("price"),
                                 F.lit(1).cast("bigint").alias("volume"))
    stored = with_date_parts(raw)
    full = stored.select(*[F.col(f.name) if f.name in stored.columns else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in RAW_VOLUMES.fields])
    S.write_days(full, f"{folder}/raw")
    with session.setting(spark, "spark.sql.session.timeZone", "America/New_York"):
        M.migrate(spark, "volumes", f"{folder}/raw", f"{folder}/table", "2024-01-01")
        moved = M.read_table(spark, "volumes", f"{folder}/table")
        assert moved.count() == 24 and {str(r.date) for r in moved.select("date").distinct().collect()} == {"2024-01-01"}
        M.backfill(spark, "volumes", f"{folder}/raw", f"{folder}/daily", "2024-01-01")
    daily = spark.read.parquet(f"{folder}/daily").collect()
    assert [(str(r.date), r.record_count) for r in daily] == [("2024-01-01", 24)]


def test_rows_outside_the_range_fail_the_job(spark):
    with pytest.raises(Exception, match="row outside of"):
        M._within(rows(spark, A1, A2), date(2024, 1, 1), date(2024, 1, 1)).collect()


def test_intermediate_folders_go(spark):
    session.release(spark)
    root = f"{session.shared_dir(spark)}/tickwell"
    from __spark_entry__ import queries
    assert queries()["cumulative_volume"](spark, "/root/testdata/sf0.001").count() > 0
    assert queries()["migrate_volumes"](spark, "/root/testdata/sf0.001").count() > 0
    assert os.listdir(root)
    assert session.release(spark) > 0
    assert not os.listdir(root)


# Histories that know removals ------------------------------------------------------

def raw_day(spark, folder, *items):
    """One raw volume day in a fresh folder: (symbol, second of the day, price)."""
    path = f"{folder}/raw-{len(os.listdir(folder))}"
    at = [datetime(2024, 1, 2, 0, 0, second) for _, second, _ in items]
    df = spark.createDataFrame([(s, t, p) for (s, _, p), t in zip(items, at)], "symbol string, event_timestamp timestamp, price double")
    full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in RAW_VOLUMES.fields if f.name not in ("year", "month", "day", "hour")])
    S.write_days(with_date_parts(full), path)
    return path


def state(df):
    return sorted((r.symbol, r.timestamp.second, r.price) for r in df.collect())


def test_removed_rows_do_not_come_back(spark, folder):
    recorded, target = f"{folder}/recorded", f"{folder}/table"
    steps = [[("A", 1, 1.0), ("B", 2, 2.0), ("C", 3, 3.0)], [("A", 1, 1.0), ("C", 3, 3.5)],
             [("A", 1, 1.0), ("B", 2, 2.0), ("C", 3, 3.0)], []]
    for k, items in enumerate(steps, 1):
        root = raw_day(spark, folder, *items) if items else f"{folder}/none"
        for _ in range(2):
            M.migrate(spark, "volumes", root, target, "2024-01-02", recorded=recorded, committed_at=f"2024-02-0{k} 00:00:00")
    rows = H.versions(spark, recorded, C.TABLES["stock_volumes"])
    for k, items in enumerate(steps, 1):
        assert state(H.as_of(rows, f"2024-02-0{k} 12:00:00")) == sorted(items), k
    assert H.as_of(rows).count() == 0 == M.read_table(spark, "volumes", target).count()
    # what stays the same is not recorded again: 3, then a change and a removal, then both back, then three removals
    assert {r.committed_at.day: r["rows"] for r in H.commits(rows).collect()} == {1: 3, 2: 2, 3: 2, 4: 3}
    intervals = H.validity(rows)
    for k in range(1, 5):
        for hour in (0, 12):
            moment = f"2024-02-0{k} {hour:02}:00:00"
            assert state(H.valid_at(intervals, moment)) == state(H.as_of(rows, moment))
    assert H.valid_at(intervals).count() == 0 and H.valid_at(intervals, "2024-01-31").count() == 0
    got = [(r.current_from.day, r.current_until and r.current_until.day, r.rows_begun, r.rows_ended, r.rows_restored, r.rows_held)
           for r in H.states(rows).orderBy("current_from").collect()]
    assert got == [(1, 2, 3, 0, 0, 3), (2, 3, 1, 2, 0, 2), (3, 4, 2, 1, 2, 3), (4, None, 0, 3, 0, 0)]


def test_changes_count_copies_and_nulls(spark):
    known = spark.createDataFrame(
        [("a", 1, 1.0, None), ("a", 1, 1.0, None), ("b", 1, 1.0, None), ("c", 1, None, 1.0), ("d", 1, 4.0, None), (None, 1, 1.0, 1.0)],
        "symbol string, n int, p double, q double").withColumns({
            "date": F.lit("2024-01-01").cast("date"), "committed_at": F.lit("2024-01-02").cast("timestamp"), "deleted": F.lit(False)})
    now = spark.createDataFrame(
        [("a", 1, 1.0, None), ("b", 1, 1.0, None), ("c", 1, 1.0, None), ("e", 1, 1.0, None), (None, 1, 1.0, 1.0)],
        "symbol string, n int, p double, q double").withColumn("date", F.lit("2024-01-01").cast("date"))
    got = {r.symbol: r.change for r in H.changes(known, now, ("symbol",)).collect()}
    assert got == {"a": "changed", "c": "changed", "d": "removed", "e": "added"}


def test_days_outside_of_the_range_stay(spark, folder):
    path = f"{folder}/history"
    H.record_changes(rows(spark, A1, A2), path, SCHEMA, date(2024, 1, 1), date(2024, 1, 2), committed_at="2024-01-10")
    H.record_changes(rows(spark).limit(0), path, SCHEMA, date(2024, 1, 2), date(2024, 1, 2), committed_at="2024-01-11")
    assert bag(H.as_of(H.versions(spark, path, SCHEMA))) == [A1]


def test_expired_removals_go_with_what_they_hide(spark, folder):
    path = f"{folder}/history"
    H.record(rows(spark, A1, B1), path, "2024-01-10")
    H.record(rows(spark, B1), path, "2024-01-20", deleted=True)
    kept = H.without_superseded(H.versions(spark, path, SCHEMA), "2024-01-25")
    assert [(r.symbol, r.deleted) for r in kept.collect()] == [("A", False)]
    early = H.without_superseded(H.versions(spark, path, SCHEMA), "2024-01-15")
    assert sorted((r.symbol, r.deleted) for r in early.collect()) == [("A", False), ("B", False), ("B", True)]


def test_bucketed_versions_need_no_shuffle(spark, folder, versions, capsys):
    name = session.fresh_table(spark, "test")
    stored = H.bucketed(versions, name, f"{folder}/bucketed", buckets=4)
    for df in (H.compare(stored, "2024-01-20", "2024-01-30"), H.as_of(stored, "2024-01-20", nulls=False), H.validity(stored)):
        df.explain()
        # a small table of newest commits may still be broadcast
        assert "Exchange hashpartitioning" not in capsys.readouterr().out
    assert sorted(map(str, H.compare(stored, "2024-01-20", "2024-01-30").collect())) == sorted(
        map(str, H.compare(versions, "2024-01-20", "2024-01-30").collect()))
    assert bag(H.as_of(stored, "2024-01-20", nulls=False)) == bag(H.as_of(versions, "2024-01-20"))
    H.compare(stored, "2024-01-20", "2024-01-30").explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    with pytest.raises(Exception, match="symbol is NULL"):
        H.bucketed(versions.withColumn("symbol", F.lit(None).cast("string")), name, f"{folder}/bucketed", buckets=4)
    session.release(spark)
    assert not spark.catalog.tableExists(name)


# Upkeep ------------------------------------------------------------------------------

SMALL_ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("date", T.DateType())])


def grow(spark, path, day, rows, times):
    for k in range(times):
        (spark.range(k * rows, (k + 1) * rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(day).cast("date").alias("date"))
         .coalesce(1).write.mode("append").partitionBy("date").parquet(path))


def names(path):
    return {f"{os.path.basename(d)}/{f}" for d, _, found in os.walk(path) for f in found if f.endswith(".parquet")}


def test_compaction_packs_small_files_only(spark, folder):
    path = f"{folder}/table"
    grow(spark, path, "2024-01-01", 50, 6)
    grow(spark, path, "2024-01-01", 20_000, 1)
    grow(spark, path, "2024-01-02", 50, 1)
    before, rows_before = names(path), sorted(spark.read.schema(SMALL_ROWS).parquet(path).collect())
    sizes = {f.rsplit("/", 1)[1]: os.path.getsize(f"{path}/{f}") for f in before}
    large = max(sizes, key=sizes.get)
    small = sorted(v for k, v in sizes.items() if k != large)[0]
    # room for two of the small files, about
    done = M2.compact(spark, path, SMALL_ROWS, target=2 * small + 100, small_below=4 * small)
    after = names(path)
    assert (done.files_before, done.files_rewritten, done.files_written, done.files_after) == (8, 6, 3, 5) and len(after) == 5
    # the large file and the file that has no company are the same files
    kept = {f for f in before if f.endswith(large) or f.startswith("date=2024-01-02")}
    assert before & after == kept and len(kept) == 2
    assert sorted(spark.read.schema(SMALL_ROWS).parquet(path).collect()) == rows_before
    again = M2.compact(spark, path, SMALL_ROWS, target=2 * small + 100, small_below=small + 1)
    assert again.files_rewritten == 0 and names(path) == after and not [d for d in os.listdir(path) if d.startswith("_compact")]


def test_compaction_of_chosen_days(spark, folder):
    path = f"{folder}/table"
    for day in ("2024-01-01", "2024-01-02"):
        grow(spark, path, day, 5, 3)
    done = M2.compact(spark, path, SMALL_ROWS, where="date = DATE '2024-01-02'")
    assert (done.files_before, done.files_after) == (3, 1) and len(names(f"{path}/date=2024-01-01")) == 3
    assert spark.read.schema(SMALL_ROWS).parquet(path).count() == 30


@pytest.mark.parametrize("moved", [False, True])
def test_a_compaction_that_died_is_finished(spark, folder, monkeypatch, moved):
    path = f"{folder}/table"
    grow(spark, path, "2024-01-01", 5, 3)
    grow(spark, path, "2024-01-02", 5, 3)
    real = M2.file_system

    def dies(session_, target):
        if target.endswith(".parquet") and (not moved or "_compact-" not in target and "/table/date" in target and target.split("/")[-1] in old):
            raise KeyboardInterrupt
        return real(session_, target)

    old = {f.split("/")[-1] for f in names(path)}
    monkeypatch.setattr(M2, "file_system", dies)
    with pytest.raises(KeyboardInterrupt):
        M2.compact(spark, path, SMALL_ROWS)
    monkeypatch.undo()
    assert M2.finish(spark, path) == 1 and len(names(path)) == 2
    assert sorted(r.id for r in spark.read.schema(SMALL_ROWS).parquet(path).collect()) == sorted([*range(15)] * 2)
    # one that died while it wrote is thrown away
    os.makedirs(f"{path}/_compact-x/new/date=2024-01-01")
    assert M2.finish(spark, path) == 1 and os.listdir(path).count("_compact-x") == 0 and M2.finish(spark, f"{folder}/none") == 0


def test_steps_of_a_failed_table_are_skipped(spark):
    def fail(_):
        raise ValueError("broken")

    steps = [M2.Step("a", "one", fail), M2.Step("a", "two", lambda s: None), M2.Step("b", "one", lambda s: M2.Compaction(3, 2, 1)),
             M2.Step("b", "two", fail, enabled=False)]
    got = {(r.table, r.step): (r.status, r.files_before, r.files_after, r.error) for r in M2.run_steps(spark, steps).collect()}
    assert got == {("a", "one"): ("failed", None, None, "ValueError: broken"), ("a", "two"): ("skipped", None, None, None),
                   ("b", "one"): ("ok", 3, 2, None), ("b", "two"): ("off", None, None, None)}


def test_replacing_days_runs_one_job(spark, folder):
    """Which days there are is observed by the write."""
    group = "replace-days-test"
    spark.sparkContext.setJobGroup(group, group)
    try:
        written = S.replace_days(day_rows(spark), folder, date(2024, 1, 29), date(2024, 2, 5))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert written == 20 and sum(1 for d, _, f in os.walk(folder) if any(x.endswith(".parquet") for x in f)) == 5
    # the shuffle's map side, then the write
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 2
    assert S.replace_days(day_rows(spark, n=2), folder, date(2024, 1, 29), date(2024, 2, 5)) == 20
    assert {r.day for r in spark.read.schema(DAYS).parquet(folder).collect()} == {30, 31}
