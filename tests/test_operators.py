import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickwell.operators import analytics as A
from tickwell.operators import daily as D
from tickwell.operators import monitoring as M
from tickwell.operators.lookup import lookup_join
from tickwell.session import setting
from tickwell.operators.running import running_total

TICK = "tick_id bigint, symbol string, event_timestamp timestamp_ntz, price double, high double, low double, volume bigint"


def ticks(spark, *rows):
    return spark.createDataFrame([(i, s, t, p, p, p, v) for i, (s, t, p, v) in enumerate(rows)], TICK)


def test_window_boundaries(spark):
    """A row on a boundary belongs to the window that starts there."""
    df = ticks(spark, ("A", datetime(2024, 1, 1, 0, 1, 0), 1.0, 1), ("A", datetime(2024, 1, 1, 0, 1, 29, 999999), 2.0, 1),
               ("A", datetime(2024, 1, 1, 0, 1, 30), 4.0, 1))
    got = {(r.window_start.minute, r.window_start.second): r.record_count
           for r in D.window_prices(df, "1 minute", "30 seconds").collect()}
    assert got == {(0, 30): 2, (1, 0): 3, (1, 30): 1}
    tumbling = D.window_volumes(df, "1 minute", None).collect()
    assert [(r.window_start.minute, r.total_volume, r.avg_price) for r in tumbling] == [(1, 3, 7 / 3)]


def test_daily_date_choice(spark):
    base = [("A", 1.0, 1)]
    schema = "symbol string, price double, volume bigint"
    plain = spark.createDataFrame(base, schema)
    text = plain.withColumn("timestamp", F.lit("2024-01-02T23:59:59.000001Z"))
    both = text.withColumn("event_timestamp", F.lit("2024-01-03 00:00:00").cast("timestamp"))
    for df, expected in ((plain, date(2024, 1, 1)), (text, date(2024, 1, 2)), (both, date(2024, 1, 3))):
        assert D.daily_prices(df, "2024-01-01", D.CORE_MEASURES).first().date == expected
        assert D.daily_volumes(df, "2024-01-01").first().date == expected


def test_zero_average_price(spark):
    df = ticks(spark, ("A", datetime(2024, 1, 1), 0.0, 1))
    assert D.daily_prices(df, measures=D.CORE_MEASURES).first().price_range_pct is None


def daily(spark, *rows):
    return spark.createDataFrame([(s, date.fromisoformat(d), p, v) for s, d, p, v in rows],
                                 "symbol string, date date, avg_price double, total_volume bigint")


def test_moving_average_counts_rows_not_days(spark):
    rows = [("A", f"2024-01-{d:02d}", float(d), 1) for d in (1, 2, 3, 10, 11, 12, 13, 14, 20)]
    got = [(r.date.day, r.moving_avg_7d) for r in A.moving_average(daily(spark, *rows), "2024-01-20").collect()]
    assert got[0] == (1, 1.0) and got[2] == (3, 2.0)
    assert got[-1] == (20, pytest.approx((3 + 10 + 11 + 12 + 13 + 14 + 20) / 7))


def test_trailing_includes_both_ends(spark):
    df = daily(spark, *[("A", f"2024-01-{d:02d}", 1.0, 1) for d in range(1, 21)])
    assert A.trailing(df, 7, "2024-01-20").count() == 8


def test_correlation_needs_two_common_dates(spark):
    one = daily(spark, ("A", "2024-01-01", 1.0, 1), ("B", "2024-01-01", 2.0, 1), ("B", "2024-01-02", 3.0, 1))
    assert A.symbol_correlation(one, "A", "B", "2024-01-02").first()[0] is None
    two = one.unionAll(daily(spark, ("A", "2024-01-02", 5.0, 1)))
    assert A.symbol_correlation(two, "A", "B", "2024-01-02").first()[0] == pytest.approx(1.0)


def test_one_row_statistics(spark):
    df = daily(spark, ("A", "2024-01-01", 1.0, 3)).withColumn("avg_price_change_pct", F.lit(1.0))
    assert A.volatility(df, "2024-01-01").first().volatility is None
    assert A.volume_distribution(df, "2024-01-01").first().median_volume == 3.0


def test_median_interpolates(spark):
    df = daily(spark, *[("A", f"2024-01-0{d}", 1.0, v) for d, v in ((1, 1), (2, 2), (3, 10), (4, 20))])
    assert A.volume_distribution(df, "2024-01-04").first().median_volume == 6.0


def test_unusual_volume_uses_its_own_ranges(spark):
    rows = [("A", str(date(2024, 1, 31) - timedelta(days=i)), 1.0, 100 if i in (3, 20) else 1) for i in range(60)]
    got = A.unusual_volume_days(daily(spark, *rows), "2024-01-31").collect()
    assert [r.date for r in got] == [date(2024, 1, 28)]
    mean = (2 * 100 + 29) / 31
    assert got[0].avg_volume == pytest.approx(mean) and got[0].volume_multiplier == pytest.approx(100 / mean)


@pytest.mark.parametrize("hot_share", [0.0, 0.5, 1.0])
def test_running_total_matches_brute_force(spark, hot_share):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "HOT" if rng.random() < hot_share else rng.choice(["A", "B", None])
        rows.append((key, rng.randrange(50), i, rng.choice([None, *range(-5, 20)])))
    df = spark.createDataFrame(rows, "k string, t int, id int, v bigint").repartition(5)
    got = {r.id: r.total for r in running_total(df, ["k"], ["t", "id"], "v", "total").collect()}
    sums, expected = defaultdict(int), {}
    for key, t, i, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        sums[key] += v or 0
        expected[i] = sums[key]
    assert got == expected


def test_hot_key_spreads_over_slices(spark):
    df = spark.range(0, 20000, 1, 4).selectExpr("'X' AS k", "id AS t", "1L AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = running_total(df, ["k"], ["t"], "v", "total")
        assert rows.agg(F.max("total")).first()[0] == 20000
        sizes = df.repartitionByRange("k", "t").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 20000 / 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lookup_join_broadcasts_by_bytes(spark, capsys):
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    lookup = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for bound, strategy in (("10m", "BroadcastHashJoin"), ("100", "SortMergeJoin")):
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", bound):
            joined = lookup_join(fact, lookup, ["k"])
            joined.explain()
            assert strategy in capsys.readouterr().out
            assert joined.filter("w = 2 * k").count() == 1000


# Alert rules ----------------------------------------------------------------

def brute_force_episodes(values, breached, for_windows):
    out, run = [], []
    for i, v in enumerate([*values, None]):
        if v is not None and breached(v):
            run.append((i, v))
        else:
            if len(run) >= for_windows:
                out.append((run[0][0], len(run), min(x for _, x in run), max(x for _, x in run)))
            run = []
    return out


@pytest.mark.parametrize("seed", range(3))
def test_episodes_match_brute_force(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([0, 0, 0, 5, 30, 31]) for _ in range(400)]
    series = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "bucket bigint, value double").repartition(4)
    got = M.episodes(series, F.col("value") < 30, 300, 600, "x", "warning").collect()
    start = datetime(1970, 1, 1)
    found = sorted(((r.breached_from - start).total_seconds() / 300, r.windows, r.min_value, r.max_value) for r in got)
    assert found == brute_force_episodes(values, lambda v: v < 30, 2)
    assert all((r.resolved_at - r.breached_from).total_seconds() == r.windows * 300 for r in got)


def test_empty_windows_breach_and_threshold_is_strict(spark):
    def at(second):
        return datetime(2024, 1, 1) + timedelta(seconds=second)

    # 30 messages are exactly 0.1 per second: not low. Then two empty windows.
    rows = [("A", at(i), 1.0, 1) for i in range(30)] + [("A", at(900 + i), 1.0, 1) for i in range(30)]
    got = M.low_ingestion(ticks(spark, *rows)).collect()
    assert [(r.breached_from, r.windows, r.max_value) for r in got] == [(at(300), 2, 0.0)]
    assert got[0].firing_from == at(900) and got[0].resolved_at == at(900)
    errors = M.high_error_rate(ticks(spark, *rows, ("A", at(1), 1.0, 1)), F.col("symbol") == "A").collect()
    assert [(r.breached_from, r.windows) for r in errors] == [(at(0), 1)]


def test_lag_carries_over_quiet_windows(spark):
    def frame(*seconds):
        return spark.createDataFrame([(datetime(1970, 1, 1) + timedelta(seconds=s),) for s in seconds],
                                     "event_timestamp timestamp_ntz")

    lag = M.consumer_lag(frame(0, 1, 2, 1500), frame(1600, 1601, 299)).orderBy("bucket").collect()
    assert [r.value for r in lag] == [2, 2, 2, 2, 2, 1]
    assert M.high_lag(frame(0, 1, 2, 1500), frame(1600, 1601, 299), threshold=1).first().windows == 5


def test_no_events_no_alerts_without_a_range(spark):
    assert M.low_ingestion(ticks(spark).limit(0)).count() == 0


def test_outage_until_now_and_from_the_start(spark):
    def at(minute):
        return datetime(2024, 1, 1) + timedelta(minutes=minute)

    rows = [("A", at(m) + timedelta(seconds=s), 1.0, 1) for m in range(50) for s in range(0, 60, 5)]
    assert M.low_ingestion(ticks(spark, *rows)).count() == 0
    got = M.low_ingestion(ticks(spark, *rows), start="2023-12-31 23:00:00", until="2024-01-01 02:02:00").orderBy("breached_from")
    assert [(r.breached_from, r.resolved_at) for r in got.collect()] == [(at(-60), at(0)), (at(50), at(120))]
    nothing = M.low_ingestion(ticks(spark).limit(0), start="2024-01-01 00:00:00", until="2024-01-01 01:00:00")
    assert [(r.breached_from, r.windows) for r in nothing.collect()] == [(at(0), 12)]


def test_a_wrong_clock_costs_one_stretch(spark):
    far = ticks(spark, ("A", datetime(1970, 1, 1), 1.0, 1), ("A", datetime(2024, 1, 1), 1.0, 1))
    got = M.low_ingestion(far, threshold=0.001).collect()
    assert len(got) == 1 and got[0].windows > 5_000_000


def test_latest_row_breaks_ties_by_id(spark):
    t = datetime(2024, 1, 1)
    df = ticks(spark, ("A", t, 1.0, 1), ("A", t, 2.0, 1), ("B", t, 3.0, 1), ("A", t - timedelta(days=1), 9.0, 1))
    assert {r.symbol: r.price for r in D.latest_per_symbol(df).collect()} == {"A": 2.0, "B": 3.0}


def test_latest_row_with_missing_symbol_or_time(spark):
    df = ticks(spark, (None, datetime(2024, 1, 1), 1.0, 1), (None, datetime(2024, 1, 2), 2.0, 1), ("A", None, 3.0, 1),
               ("A", None, 4.0, 1))
    assert {r.symbol: r.price for r in D.latest_per_symbol(df).collect()} == {None: 2.0, "A": 4.0}
