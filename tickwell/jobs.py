"""Command line of the jobs, for ``spark-submit`` or ``python -m tickwell.jobs``.

Datasets live under one root: ``prices/raw``, ``volumes/raw`` (streams), ``prices/daily``,
``volumes/daily`` (daily job), ``<kind>/rejects`` (messages that became no tick), ``tables/<name>``
(by date), ``history/<name>`` (row versions with commit times).
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwell.functions.ticks import parse_messages, with_price_change
from tickwell.operators import history, maintenance, migration, quality
from tickwell.schemas import PRICE_MESSAGE, RAW_PRICES, RAW_VOLUMES
from tickwell.session import path_exists, release, setting, stream_session
from tickwell.sources.days import as_day
from tickwell.sources.inventory import path_inventory
from tickwell.sources.messages import drain_messages
from tickwell.sources.tables import TABLES, create_all_tables, register_views
from tickwell.streaming.pipelines import MODES, StreamSettings, start_streams, wait

KINDS = {"prices": "stock_prices", "volumes": "stock_volumes", "daily": "daily_aggregates"}


def raw_root(root: str, kind: str) -> str:
    return f"{root}/{kind}/raw"


def daily_root(root: str, kind: str) -> str:
    return f"{root}/{kind}/daily"


def table_path(root: str, kind: str) -> str:
    return f"{root}/tables/{KINDS[kind]}"


def history_path(root: str, table: str) -> str:
    return f"{root}/history/{table}"


def deliver(df: DataFrame, rows: int, output: str | None) -> None:
    """Writes the whole result as Parquet, or prints its first rows."""
    if output is None:
        df.show(rows, truncate=False)
    else:
        df.write.mode("overwrite").parquet(output)


def run_daily(spark: SparkSession, root: str, start: str | date | None = None,
              end: str | date | None = None) -> None:
    """Daily aggregates of prices and volumes; a day without data writes nothing."""
    for kind in ("prices", "volumes"):
        migration.backfill(spark, kind, raw_root(root, kind), daily_root(root, kind), start, end)


def run_quality(spark: SparkSession, root: str, day: str | date | None = None) -> bool:
    """Prints all checks of a day and returns whether prices and volumes both passed."""
    report = None
    for kind, schema in (("prices", RAW_PRICES), ("volumes", RAW_VOLUMES)):
        one = quality.day_report(spark, raw_root(root, kind), schema, kind, day, f"{root}/{kind}/rejects")
        report = one if report is None else report.unionAll(one)
    report.show(truncate=False)
    return quality.overall_verdict(quality.verdict(report)).first()["passed"]


def run_migration(spark: SparkSession, root: str, kind: str = "all", start: str | date | None = None,
                  end: str | date | None = None, record: bool = False) -> None:
    roots = {"prices": raw_root(root, "prices"), "volumes": raw_root(root, "volumes"),
             "daily": daily_root(root, "prices")}
    for one in KINDS if kind == "all" else (kind,):
        migration.migrate(spark, one, roots[one], table_path(root, one), start, end,
                          history_path(root, KINDS[one]) if record else None)


def run_time_travel(spark: SparkSession, root: str, table: str, operation: str, first: str | None,
                    second: str | None, symbol: str | None, rows: int = 100, output: str | None = None) -> None:
    keys = ("symbol", "date") if table == "daily_aggregates" else history.KEYS
    value = "avg_price" if table == "daily_aggregates" else "price"
    versions = history.versions(spark, history_path(root, table), TABLES[table])
    frames = {
        "commits": lambda: history.commits(versions).orderBy("committed_at"),
        "as-of": lambda: history.as_of(versions, first, keys),
        "symbol": lambda: history.symbol_as_of(versions, symbol, first, rows, keys, keys[1:]),
        "compare": lambda: history.compare(versions, first, second, keys, value),
        "states": lambda: history.states(versions, keys).orderBy("current_from"),
        "validity": lambda: history.validity(versions, keys),
    }
    deliver(frames[operation](), rows, output)


def upkeep_steps(spark: SparkSession, root: str, start: str | date, end: str | date, retention_days: int = 7,
                 target_bytes: int = maintenance.TARGET_BYTES, compaction: bool = True, expiry: bool = True) -> list[maintenance.Step]:
    """What keeps the tables and histories below ``root`` in shape: in histories, row versions that were replaced before
    the retention time go; then small files of the given days are packed. Absent paths have no steps."""
    first, last = as_day(start, spark), as_day(end, spark)
    before = spark.range(1).select(F.current_timestamp() - F.make_dt_interval(days=F.lit(retention_days))).first()[0]
    days = f"date BETWEEN DATE '{first}' AND DATE '{last}'"
    steps = []
    for kind, name in KINDS.items():
        table, past = table_path(root, kind), history_path(root, name)
        schema, keys = TABLES[name], migration.keys_of(kind)
        versioned = StructType(schema.fields + history.VERSION_FIELDS)
        if path_exists(spark, past):
            steps.append(maintenance.Step(f"history/{name}", "expire", lambda own, p=past, s=schema, k=keys: maintenance.expire(
                own, p, s, first, last, before, k), expiry))
        for label, path, columns in ((name, table, schema), (f"history/{name}", past, versioned)):
            if path_exists(spark, path):
                steps.append(maintenance.Step(label, "compact", lambda own, p=path, s=columns: maintenance.compact(
                    own, p, s, target=target_bytes, where=days), compaction))
    return steps


def run_optimize(spark: SparkSession, root: str, start: str | date, end: str | date, retention_days: int = 7, **options) -> bool:
    """Upkeep of all tables side by side. Prints a status row for each step, and returns whether none failed."""
    statuses = maintenance.run_steps(spark, upkeep_steps(spark, root, start, end, retention_days, **options))
    statuses.show(100, truncate=False)
    return statuses.where("status = 'failed'").isEmpty()


def run_sql(spark: SparkSession, root: str, text: str, rows: int = 100, output: str | None = None) -> None:
    """SQL over ``stock_prices``, ``stock_volumes`` and ``daily_aggregates``."""
    register_views(spark, {name: migration.read_table(spark, kind, table_path(root, kind)) for kind, name in KINDS.items()})
    deliver(spark.sql(text), rows, output)


def run_consumer(spark: SparkSession, source: str, backing: str, servers: str, symbol: str | None,
                 rows: int = 100, output: str | None = None) -> None:
    """What a price topic holds, optionally for one symbol, with the change in percent."""
    messages = drain_messages(spark, source, backing, bootstrap_servers=servers)
    prices = with_price_change(parse_messages(messages, PRICE_MESSAGE))
    if symbol:
        prices = prices.filter(prices.symbol == symbol)
    deliver(prices.select("symbol", "price", "volume", "price_change_pct", "timestamp"), rows, output)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tickwell.jobs", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, result: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--root", required=True)
        sub.add_argument("--zone", default="UTC", help="time zone of dates and folders, the same for all jobs")
        if result:
            sub.add_argument("--rows", type=int, default=100, help="rows to print")
            sub.add_argument("--output", help="write the whole result there as Parquet instead")
        return sub

    stream = job("stream", "run streaming queries")
    stream.add_argument("--mode", choices=MODES, default="all")
    stream.add_argument("--checkpoints", required=True)
    stream.add_argument("--second-root", help="write raw ticks there as well")
    stream.add_argument("--prices", default="stock-prices", help="topic or folder")
    stream.add_argument("--volumes", default="stock-volumes", help="topic or folder")
    stream.add_argument("--backing", choices=("kafka", "files"), default="kafka")
    stream.add_argument("--bootstrap-servers", default="localhost:9092")
    stream.add_argument("--starting-offsets", choices=("latest", "earliest"), default="latest")
    stream.add_argument("--trigger", default="10 seconds", help="interval, or 'once' to stop at the end")
    stream.add_argument("--watermark", default="1 minute")
    stream.add_argument("--window", default="1 minute")
    stream.add_argument("--slide", default="30 seconds", help="or 'none' for tumbling windows")
    stream.add_argument("--state-partitions", type=int)
    stream.add_argument("--max-offsets-per-trigger", type=int, help="messages of one batch at most (kafka)")
    stream.add_argument("--max-files-per-trigger", type=int, help="files of one batch at most (files)")
    stream.add_argument("--min-partitions", type=int, help="read a topic with at least so many tasks (kafka)")

    for name, text in (("daily", "aggregate days"), ("migrate", "move days into tables")):
        sub = job(name, text)
        sub.add_argument("--start-date", "--date", dest="start")
        sub.add_argument("--end-date", dest="end")
        if name == "migrate":
            sub.add_argument("--type", choices=("all", *KINDS), default="all")
            sub.add_argument("--record", action="store_true", help="bring the history up to date as well, removals included")

    job("quality", "check a day; exit status 1 if it fails").add_argument("--date")

    optimize = job("optimize", "pack small files of all tables, drop replaced row versions; exit status 1 if a step fails")
    optimize.add_argument("--start-date", "--date", dest="start")
    optimize.add_argument("--end-date", dest="end")
    optimize.add_argument("--retention-days", type=int, default=7)
    optimize.add_argument("--target-mb", type=int, default=maintenance.TARGET_BYTES >> 20, help="size of a packed file")
    optimize.add_argument("--no-compaction", action="store_true")
    optimize.add_argument("--no-expiry", action="store_true")

    travel = job("time-travel", "look at row versions of a table", result=True)
    travel.add_argument("--table", choices=tuple(TABLES), required=True)
    travel.add_argument("--operation", required=True, choices=("commits", "states", "validity", "as-of", "symbol", "compare"))
    travel.add_argument("--timestamp", help="as of; for compare the earlier time")
    travel.add_argument("--timestamp-2", help="for compare the later time")
    travel.add_argument("--symbol")

    job("sql", "run SQL over the tables by name", result=True).add_argument("--query", required=True)

    consume = job("consume", "the messages of a price topic", result=True)
    consume.add_argument("--source", default="stock-prices")
    consume.add_argument("--backing", choices=("kafka", "files"), default="kafka")
    consume.add_argument("--bootstrap-servers", default="localhost:9092")
    consume.add_argument("--symbol")

    job("inventory", "which datasets exist and how large they are")
    job("create-tables", "create the tables that are absent")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tickwell-{args.job}").getOrCreate()
    with setting(spark, "spark.sql.session.timeZone", args.zone):
        try:
            return _run(args, spark)
        finally:
            release(spark)


def _run(args: argparse.Namespace, spark: SparkSession) -> int:
    if args.job == "stream":
        settings = StreamSettings(trigger=None if args.trigger == "once" else args.trigger,
                                  watermark_delay=args.watermark, window=args.window,
                                  slide=None if args.slide == "none" else args.slide)
        options = {"backing": args.backing}
        if args.backing == "kafka":
            options |= {"bootstrap_servers": args.bootstrap_servers, "starting_offsets": args.starting_offsets,
                        "offsets_per_trigger": args.max_offsets_per_trigger, "min_partitions": args.min_partitions}
        else:
            options["files_per_trigger"] = args.max_files_per_trigger
        own = stream_session(spark, args.state_partitions)
        wait(own, start_streams(own, args.mode, args.prices, args.volumes, args.root, args.checkpoints,
                                settings, args.second_root, **options), settings)
    elif args.job == "daily":
        run_daily(spark, args.root, args.start, args.end)
    elif args.job == "quality":
        return 0 if run_quality(spark, args.root, args.date) else 1
    elif args.job == "migrate":
        run_migration(spark, args.root, args.type, args.start, args.end, args.record)
    elif args.job == "optimize":
        done = run_optimize(spark, args.root, args.start, args.end or args.start, args.retention_days,
                            target_bytes=args.target_mb << 20, compaction=not args.no_compaction, expiry=not args.no_expiry)
        return 0 if done else 1
    elif args.job == "time-travel":
        run_time_travel(spark, args.root, args.table, args.operation, args.timestamp, args.timestamp_2,
                        args.symbol, args.rows, args.output)
    elif args.job == "sql":
        run_sql(spark, args.root, args.query, args.rows, args.output)
    elif args.job == "consume":
        run_consumer(spark, args.source, args.backing, args.bootstrap_servers, args.symbol, args.rows, args.output)
    elif args.job == "inventory":
        datasets = {f"{kind}_{part}": f"{args.root}/{kind}/{part}"
                    for kind in ("prices", "volumes") for part in ("raw", "rejects", "daily")}
        path_inventory(spark, datasets).show(truncate=False)
    elif args.job == "create-tables":
        create_all_tables(spark, "tickwell", f"{args.root}/catalog")
    return 0


if __name__ == "__main__":
    sys.exit(main())
