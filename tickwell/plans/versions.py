"""Time travel over rows with commit times, comparison, maintenance, schema changes.

The history is fixed: three appends by date, then a correction of one symbol's price by
one percent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.operators import history as H
from tickwell.operators import timetravel
from tickwell.plans import frames as X
from tickwell.plans.analytics import SYMBOL
from tickwell.plans.frames import DAILY_CORE, QUOTES, plain, with_ctes
from tickwell.plans.registry import query
from tickwell.schemas import VOLUMES_TABLE
from tickwell.operators import migration as M
from tickwell.plans.storage import span, stored_raw
from tickwell.schemas import RAW_VOLUMES
from tickwell.session import fresh_dir, fresh_table, staged
from tickwell.sources.days import replace_days, write_days

# (rows up to this day, committed at)
APPENDS = (("2024-01-11", "2024-01-11 00:00:00"), ("2024-01-21", "2024-01-21 00:00:00"),
           ("9999-12-31", "2024-01-31 00:00:00"))
CORRECTED = "2024-02-01 00:00:00"
TICK = T.StructType([T.StructField("tick_id", T.LongType()), *VOLUMES_TABLE.fields])
KEYS = ("symbol", "timestamp", "tick_id")


def _rows(spark, sf_dir) -> DataFrame:
    return X.quotes(spark, sf_dir).select(
        "tick_id", "symbol", F.col("event_timestamp").cast("timestamp").alias("timestamp"),
        F.to_date("event_timestamp").alias("date"), "volume", "price")


def history_of(spark, sf_dir, steps: int) -> DataFrame:
    """All row versions after the first ``steps`` commits of the fixed history."""
    path = fresh_dir(spark, "versions")
    rows = _rows(spark, sf_dir)
    low = "0001-01-01"
    for high, when in APPENDS[:steps]:
        H.record(rows.filter((F.col("date") >= F.lit(low).cast("date"))
                             & (F.col("date") < F.lit(high).cast("date"))), path, when)
        low = high
    if steps >= 4:
        H.record(rows.filter(F.col("symbol") == SYMBOL).withColumn("price", F.col("price") * 1.01), path, CORRECTED)
    return H.versions(spark, path, TICK)


def _out(rows: DataFrame) -> DataFrame:
    return plain(rows.select("symbol", "timestamp", "date", "volume", "price"))


VERSIONED = """versioned AS (
  SELECT tick_id, symbol, event_timestamp AS timestamp, event_timestamp::DATE AS date, volume, price,
         CASE WHEN symbol = '%s' THEN price * 1.01 ELSE price END AS corrected FROM quotes)""" % SYMBOL
COLUMNS = "symbol, timestamp, date, volume, price"


@query(with_ctes(QUOTES, VERSIONED, select=f"SELECT {COLUMNS} FROM versioned WHERE date < DATE '2024-01-21'"))
def tt_read_at_snapshot(spark, sf_dir):
    """The state that the second commit left."""
    return _out(H.as_of(history_of(spark, sf_dir, 3), APPENDS[1][1], KEYS))


@query(with_ctes(QUOTES, VERSIONED, select=f"SELECT {COLUMNS} FROM versioned WHERE date < DATE '2024-01-11'"))
def tt_read_at_timestamp(spark, sf_dir):
    return _out(H.as_of(history_of(spark, sf_dir, 3), "2024-01-20 12:00:00", KEYS))


@query(with_ctes(QUOTES, VERSIONED, select=f"""SELECT {COLUMNS} FROM versioned
  WHERE symbol = '{SYMBOL}' AND date < DATE '2024-01-21' ORDER BY timestamp DESC, tick_id DESC LIMIT 100"""))
def tt_symbol_as_of(spark, sf_dir):
    """The newest hundred ticks of one symbol before its correction."""
    rows = history_of(spark, sf_dir, 4)
    return _out(H.symbol_as_of(rows, SYMBOL, "2024-01-21 00:00:00", 100, KEYS, ("timestamp", "tick_id")))


COMMITS = """commits AS (
  SELECT TIMESTAMP '2024-01-11' AS committed_at, date FROM versioned WHERE date < DATE '2024-01-11'
  UNION ALL SELECT TIMESTAMP '2024-01-21', date FROM versioned WHERE date >= DATE '2024-01-11' AND date < DATE '2024-01-21'
  UNION ALL SELECT TIMESTAMP '2024-01-31', date FROM versioned WHERE date >= DATE '2024-01-21'
  UNION ALL SELECT TIMESTAMP '2024-02-01', date FROM versioned WHERE symbol = '%s')""" % SYMBOL


@query(with_ctes(QUOTES, VERSIONED, COMMITS, select="""SELECT committed_at, count(*) AS rows, min(date) AS first_date,
  max(date) AS last_date FROM commits GROUP BY ALL"""))
def tt_list_snapshots(spark, sf_dir):
    return plain(H.commits(history_of(spark, sf_dir, 4)))


@query(with_ctes(QUOTES, VERSIONED, COMMITS, select="""SELECT *, (sum(rows) OVER (PARTITION BY date ORDER BY committed_at))::BIGINT AS rows_so_far
  FROM (SELECT committed_at, date, count(*) AS rows FROM commits GROUP BY ALL)"""))
def tt_history(spark, sf_dir):
    """By day, what each commit added."""
    rows = history_of(spark, sf_dir, 4).groupBy("committed_at", "date").agg(F.count("*").alias("rows"))
    so_far = X.Window.partitionBy("date").orderBy("committed_at")
    return plain(rows.withColumn("rows_so_far", F.sum("rows").over(so_far)))


@query(with_ctes(QUOTES, VERSIONED, select="""SELECT symbol, timestamp, price AS price_v1, corrected AS price_v2,
  round(corrected - price, 8) AS price_change, 1 AS copies_v1, 1 AS copies_v2 FROM versioned"""))
def tt_compare_snapshots(spark, sf_dir):
    """Of versions that are stored by key, so that comparing needs no shuffle."""
    rows = H.bucketed(history_of(spark, sf_dir, 4), fresh_table(spark, "versions"), fresh_dir(spark, "bucketed"))
    return plain(H.compare(rows, APPENDS[2][1], CORRECTED), "price_change")


@query(with_ctes(DAILY_CORE, select=f"""SELECT symbol,
  round(CASE WHEN symbol = '{SYMBOL}' THEN avg_price * 1.01 ELSE avg_price END, 8) AS current_price,
  round(avg_price, 8) AS historical_price,
  round(CASE WHEN symbol = '{SYMBOL}' THEN avg_price * 1.01 ELSE avg_price END - avg_price, 8) AS price_change
  FROM daily WHERE date = (SELECT max(date) FROM daily)"""))
def tt_current_vs_historical(spark, sf_dir):
    """Daily rows whose averages were corrected after the time looked back to."""
    daily = staged(X.daily_core(spark, sf_dir).select("symbol", "date", "avg_price"), "daily-core")
    path = fresh_dir(spark, "daily-versions")
    H.record(daily, path, "2024-01-31 00:00:00")
    H.record(daily.filter(F.col("symbol") == SYMBOL).withColumn("avg_price", F.col("avg_price") * 1.01), path, CORRECTED)
    rows = H.bucketed(H.versions(spark, path, daily.schema), fresh_table(spark, "daily"), fresh_dir(spark, "bucketed"),
                      ("symbol", "date"))
    compared = timetravel.current_vs_historical(rows, "2024-01-31 12:00:00", X.last_day(spark, sf_dir))
    return plain(compared, "current_price", "historical_price", "price_change")


# A volume table is migrated, then its raw days are corrected and migrated again: one symbol's prices
# rise, ticks with an id that 7 divides are gone, a whole day is gone, and one symbol is new in a day.
REMIGRATED = """remigrated AS (
  SELECT tick_id, symbol, event_timestamp AS timestamp, event_timestamp::DATE AS date, volume, price,
         CASE WHEN symbol = '%s' THEN price * 1.01 ELSE price END AS corrected,
         tick_id %% 7 = 0 OR event_timestamp::DATE = DATE '2024-01-20' AS removed
  FROM quotes WHERE symbol IS NOT NULL AND price > 0)""" % SYMBOL
MIGRATED_AT, REMIGRATED_AT = "2024-02-01 00:00:00", "2024-02-05 00:00:00"


def remigrated(spark, sf_dir) -> tuple[str, str]:
    """Paths of the table and of the history after both migrations."""
    first, last = span(spark, sf_dir)
    root, target, recorded = stored_raw(spark, sf_dir, "volumes"), fresh_dir(spark, "table"), fresh_dir(spark, "recorded")
    M.migrate(spark, "volumes", root, target, first, last, recorded, MIGRATED_AT)
    raw = spark.read.schema(RAW_VOLUMES).parquet(root)
    better = raw.filter((F.col("kafka_offset") % 7 != 0) & (F.to_date("event_timestamp") != F.lit("2024-01-20").cast("date"))).withColumn(
        "price", F.when(F.col("symbol") == SYMBOL, F.col("price") * 1.01).otherwise(F.col("price")))
    corrected = fresh_dir(spark, "raw-corrected")
    replace_days(better, corrected, first, last)
    for _ in range(2):  # the second time changes nothing
        M.migrate(spark, "volumes", corrected, target, first, last, recorded, REMIGRATED_AT)
    return target, recorded


@query(with_ctes(QUOTES, REMIGRATED, select="""
  SELECT 'before' AS state, symbol, timestamp, date, volume, price FROM remigrated
  UNION ALL SELECT state, symbol, timestamp, date, volume, corrected FROM remigrated CROSS JOIN (VALUES ('now'), ('table')) t(state)
  WHERE NOT removed"""))
def tt_removed_rows(spark, sf_dir):
    """Rows removed by a corrected day are gone from reads as of now, which equal the table, and
    are still there in reads as of before."""
    target, recorded = remigrated(spark, sf_dir)
    rows = H.versions(spark, recorded, VOLUMES_TABLE)
    out = M.read_table(spark, "volumes", target).select(F.lit("table").alias("state"), *VOLUMES_TABLE.fieldNames())
    for state, moment in (("before", MIGRATED_AT), ("now", None)):
        out = out.unionByName(H.as_of(rows, moment).select(F.lit(state).alias("state"), *VOLUMES_TABLE.fieldNames()))
    return plain(out)


@query(with_ctes(QUOTES, REMIGRATED, select=f"""
  SELECT symbol, timestamp, price, TIMESTAMP '{MIGRATED_AT}' AS valid_from,
         CASE WHEN removed OR corrected <> price THEN TIMESTAMP '{REMIGRATED_AT}' END AS valid_to FROM remigrated
  UNION ALL SELECT symbol, timestamp, corrected, TIMESTAMP '{REMIGRATED_AT}', NULL FROM remigrated WHERE NOT removed AND corrected <> price"""))
def tt_validity(spark, sf_dir):
    """Every version of a row with the time in which it counted, stored, so that reads are filters."""
    _, recorded = remigrated(spark, sf_dir)
    intervals = staged(H.validity(H.versions(spark, recorded, VOLUMES_TABLE)), "validity")
    return plain(intervals.select("symbol", "timestamp", "price", "valid_from", "valid_to"))


@query(with_ctes(QUOTES, REMIGRATED, select="SELECT symbol, timestamp, date, volume, price FROM remigrated"))
def tt_valid_at(spark, sf_dir):
    """A read as of a time from stored intervals."""
    _, recorded = remigrated(spark, sf_dir)
    intervals = staged(H.validity(H.versions(spark, recorded, VOLUMES_TABLE)), "validity")
    return plain(H.valid_at(intervals, "2024-02-03 12:00:00").select(*VOLUMES_TABLE.fieldNames()))


@query(with_ctes(QUOTES, REMIGRATED, select=f"""
  SELECT current_from, current_until, rows_begun::BIGINT AS rows_begun, rows_ended::BIGINT AS rows_ended,
         rows_restored::BIGINT AS rows_restored, rows_held::BIGINT AS rows_held
  FROM (SELECT count(*) AS n, count(*) FILTER (removed) AS gone, count(*) FILTER (NOT removed AND corrected <> price) AS changed FROM remigrated) c,
       LATERAL (VALUES
         (TIMESTAMP '{MIGRATED_AT}', TIMESTAMP '{REMIGRATED_AT}', n, 0, 0, n),
         (TIMESTAMP '{REMIGRATED_AT}', TIMESTAMP '2024-02-09', changed, gone + changed, 0, n - gone),
         (TIMESTAMP '2024-02-09', NULL, gone + changed, changed, gone + changed, n)
       ) t(current_from, current_until, rows_begun, rows_ended, rows_restored, rows_held)"""))
def tt_states(spark, sf_dir):
    """Which state counted when, with a rollback at the end: the first state is recorded again."""
    first, last = span(spark, sf_dir)
    _, recorded = remigrated(spark, sf_dir)
    before = staged(H.as_of(H.versions(spark, recorded, VOLUMES_TABLE), MIGRATED_AT), "before")
    H.record_changes(before, recorded, VOLUMES_TABLE, first, last, committed_at="2024-02-09 00:00:00")
    return plain(H.states(H.versions(spark, recorded, VOLUMES_TABLE)))


@query(with_ctes(QUOTES, VERSIONED, select=f"SELECT {COLUMNS} FROM versioned"))
def tt_rollback(spark, sf_dir):
    """Back to the state before the correction: that state is recorded as a new commit."""
    path = fresh_dir(spark, "versions")
    rows = history_of(spark, sf_dir, 4)
    before = H.as_of(rows, APPENDS[2][1], KEYS)
    write_days(rows, path, ("date",))
    H.record(before, path, "2024-02-03 00:00:00")
    return _out(H.as_of(H.versions(spark, path, TICK), None, KEYS))


@query(with_ctes(QUOTES, VERSIONED, select="SELECT symbol, timestamp, date, volume, corrected AS price FROM versioned"))
def compact_preserves_rows(spark, sf_dir):
    """All days written anew, then read as of now."""
    path = fresh_dir(spark, "compacted")
    write_days(history_of(spark, sf_dir, 4), path, ("date",))
    H.rewrite(H.versions(spark, path, TICK), path)
    return _out(H.as_of(H.versions(spark, path, TICK), None, KEYS))


@query(with_ctes(QUOTES, VERSIONED, COMMITS, select=f"""SELECT 'kept' AS part, (SELECT count(*) FROM versioned) AS rows
  UNION ALL SELECT 'superseded', (SELECT count(*) FROM versioned WHERE symbol = '{SYMBOL}')"""))
def expire_snapshots(spark, sf_dir):
    """Row versions that the correction replaced go; what counts now stays."""
    rows = staged(history_of(spark, sf_dir, 4), "versions")
    path = fresh_dir(spark, "expired")
    write_days(rows, path, ("date",))
    H.rewrite(H.without_superseded(H.versions(spark, path, TICK), CORRECTED, KEYS), path)
    tagged = H.versions(spark, path, TICK).select(F.lit(1).alias("kept")).unionAll(rows.select(F.lit(0).alias("kept")))
    kept = F.count_if(F.col("kept") == 1)
    counts = tagged.agg(kept.alias("kept"), (F.count("*") - 2 * kept).alias("superseded"))
    return counts.select(F.explode(F.array(
        F.struct(F.lit("kept").alias("part"), F.col("kept").alias("rows")),
        F.struct(F.lit("superseded").alias("part"), F.col("superseded").alias("rows")))).alias("p")).select("p.*")


@query(with_ctes(QUOTES, select="""SELECT symbol, event_timestamp AS timestamp, event_timestamp::DATE AS date, volume,
  price AS last_price, CASE WHEN event_timestamp >= TIMESTAMP '2024-01-16' THEN 'X' END AS venue FROM quotes"""))
def schema_evolution_read(spark, sf_dir):
    """First half written with a narrow volume; then a column is added, one renamed, one
    widened, and the second half written in the new schema. The read names the new schema:
    Parquet widens, fills in NULL, and the old name of a renamed column is read beside the new."""
    path = fresh_dir(spark, "evolving")
    rows = _rows(spark, sf_dir).drop("tick_id")
    half = F.col("date") < F.lit("2024-01-16").cast("date")
    write_days(rows.filter(half).withColumn("volume", F.col("volume").cast("int")), path, ("date",))
    write_days(rows.filter(~half).withColumnRenamed("price", "last_price").withColumn("venue", F.lit("X")), path, ("date",))
    new = T.StructType([*VOLUMES_TABLE.fields, T.StructField("last_price", T.DoubleType()),
                        T.StructField("venue", T.StringType())])
    stored = spark.read.schema(new).parquet(path)
    return plain(stored.select("symbol", "timestamp", "date", "volume",
                               F.coalesce("last_price", "price").alias("last_price"), "venue"))
