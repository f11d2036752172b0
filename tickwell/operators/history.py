"""Versions of rows in plain Parquet: rows are only appended, each with the time of its commit.

What a table held at some time are, for each key, the rows of the newest commit up to
then. There is no log and no state beside the rows; a correction appends the corrected rows,
a removal appends the key with ``deleted``. ``record_changes`` finds both by comparing what a
table holds now with what the history says.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType, TimestampType

from tickwell.operators.running import running_total
from tickwell.session import path_exists, staged
from tickwell.sources.days import overwrite_days, write_days

Moment = str | datetime | None
KEYS = ("symbol", "timestamp")
VERSION_FIELDS = [StructField("committed_at", TimestampType()), StructField("deleted", BooleanType())]


def record(rows: DataFrame, path: str, committed_at: Moment = None, deleted: bool = False) -> None:
    """Appends ``rows`` (with a ``date``) as one commit; without a time, that of the session."""
    at = F.current_timestamp() if committed_at is None else F.lit(committed_at).cast("timestamp")
    write_days(rows.withColumn("committed_at", at).withColumn("deleted", F.lit(deleted)), path, ("date",))


def versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows ever recorded. Columns that older files lack are NULL."""
    return spark.read.schema(StructType(schema.fields + VERSION_FIELDS)).parquet(path)


def _contents(columns: list[str]) -> list[Column]:
    """128 bits of a row as two numbers that can be added up. A NULL would leave a hash as it
    is, so which columns are NULL is hashed as well."""
    values = [*columns, F.array(*[F.col(c).isNull() for c in columns])]
    return [F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)") for seed in (1, 2)]


def _named(keys: tuple[str, ...]) -> tuple[str, ...]:
    """The key, and the folder it is in."""
    return keys if "date" in keys else (*keys, "date")


def changes(known: DataFrame, now: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Keys with their ``date`` whose rows differ, and whether they were added, changed or removed.

    ``known`` are row versions, ``now`` the rows as they should be; both are read once and meet
    in aggregates by key, so rows are neither joined nor compared in full. A key may have several
    rows, also equal ones: what counts is how many there are and the sum of their digests.
    """
    named = _named(keys)
    columns = [c for c in now.columns if c not in named]
    counted = ~F.col("deleted")
    old = known.select(*named, "committed_at", counted.alias("_counted"), *columns)
    new = now.select(*named, F.lit(None).cast("timestamp").alias("committed_at"), F.lit(True).alias("_counted"), *columns)
    one, two = _contents(columns)
    of_new = F.col("committed_at").isNull()
    # by commit first: a key that is stored very often is a partial row for each task
    commits_ = old.unionByName(new).groupBy(*named, "committed_at").agg(
        F.count_if("_counted").alias("n"), F.coalesce(F.sum(F.when(F.col("_counted"), one)), F.lit(0)).alias("one"),
        F.coalesce(F.sum(F.when(F.col("_counted"), two)), F.lit(0)).alias("two"))

    def newest(name: str) -> Column:
        return F.max_by(name, F.when(~of_new, F.col("committed_at")))

    sides = commits_.groupBy(*named).agg(*[
        column.alias(f"{side}_{name}") for name in ("n", "one", "two")
        for side, column in (("old", newest(name)), ("new", F.max(F.when(of_new, F.col(name)))))])
    had, has = F.coalesce("old_n", F.lit(0)) > 0, F.coalesce("new_n", F.lit(0)) > 0
    same = F.lit(True)
    for name in ("n", "one", "two"):
        same = same & (F.col(f"old_{name}") == F.col(f"new_{name}"))
    change = (F.when(has & ~had, "added").when(had & ~has, "removed").when(had & has & ~same, "changed"))
    return sides.select(*named, change.alias("change")).where("change IS NOT NULL")


def record_changes(rows: DataFrame, path: str, schema: StructType, first: date, last: date,
                   keys: tuple[str, ...] = KEYS, committed_at: Moment = None) -> None:
    """Makes the days ``first`` to ``last`` of a history say what ``rows`` say, in one commit.

    Added and changed keys get their rows, keys that are gone a row that is ``deleted``, and what
    is the same gets nothing, so doing it again adds nothing. Only the range's folders are read.
    """
    spark = rows.sparkSession
    known = versions(spark, path, schema) if path_exists(spark, path) else spark.createDataFrame([], StructType(schema.fields + VERSION_FIELDS))
    found = staged(changes(known.where(F.col("date").between(F.lit(first), F.lit(last))), rows, keys), "changes")
    named = _named(keys)
    wanted = found.where("change <> 'removed'").select(*[F.col(c).alias(f"_{c}") for c in named])
    kept = rows.join(wanted, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in named], "left_semi")
    gone = found.where("change = 'removed'").select(*[
        F.col(f.name) if f.name in named else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    at = F.current_timestamp() if committed_at is None else F.lit(committed_at).cast("timestamp")
    both = kept.select(*schema.fieldNames(), F.lit(False).alias("deleted")).unionByName(gone.withColumn("deleted", F.lit(True)))
    write_days(both.withColumn("committed_at", at), path, ("date",))


def bucketed(rows: DataFrame, name: str, path: str, keys: tuple[str, ...] = KEYS, buckets: int = 8) -> DataFrame:
    """Row versions as the catalog table ``name``, dealt over ``buckets`` by key: reads as of a time
    and comparisons of it need no shuffle. More rows are appended by doing it again with the
    same buckets. A NULL key fails the write, since it would have no bucket to be found in."""
    spark = rows.sparkSession
    known = [F.coalesce(k, F.raise_error(F.lit(f"{k} is NULL"))).alias(k) for k in keys]
    rest = [c for c in rows.columns if c not in keys]
    (rows.select(*known, *rest).repartition(buckets, *keys).write.mode("append").format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name))
    return spark.table(name).select(*rows.columns)


def _until(moment: Moment) -> Column:
    return F.lit(True) if moment is None else F.col("committed_at") <= F.lit(moment).cast("timestamp")


def _newest(rows: DataFrame, keys: tuple[str, ...], nulls: bool = True, **times: Column) -> DataFrame:
    """``rows`` with, for each name, the newest commit of the key for which the condition holds.
    A hash aggregate over key and time; the rows themselves are not sorted. Without ``nulls`` in
    keys, a join of bucketed rows needs no shuffle."""
    newest = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[F.max(F.when(condition, F.col("committed_at"))).alias(name) for name, condition in times.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) if nulls else F.col(k) == F.col(f"_{k}") for k in keys]
    return rows.join(newest, same).drop(*[f"_{k}" for k in keys])


def as_of(rows: DataFrame, moment: Moment = None, keys: tuple[str, ...] = KEYS, nulls: bool = True) -> DataFrame:
    """The rows that counted at a time, without the columns of the versions."""
    found = _newest(rows.where(_until(moment)), keys, nulls, _at=F.lit(True))
    return found.where((F.col("committed_at") == F.col("_at")) & ~F.col("deleted")).drop("_at", "committed_at", "deleted")


def symbol_as_of(rows: DataFrame, symbol: str, moment: Moment = None, n: int = 100,
                 keys: tuple[str, ...] = KEYS, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """One symbol's newest rows as they counted at a time. The symbol is a file filter."""
    found = as_of(rows.where(F.col("symbol") == symbol), moment, keys)
    rest = [c for c in found.columns if c not in order]
    return found.orderBy(*[F.col(c).desc() for c in order], *rest).limit(n)


def commits(rows: DataFrame) -> DataFrame:
    """The commits in order: time, rows, and the days they touch."""
    return rows.groupBy("committed_at").agg(
        F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def compare(rows: DataFrame, first: Moment, second: Moment, keys: tuple[str, ...] = KEYS,
            value: str = "price") -> DataFrame:
    """A value at two times side by side, one row for each key that both times have.

    Rows are read once and aggregated by key and commit, then by key, so nothing is joined and nothing
    is paired: a tick stored a thousand times on both sides stays one row. Of several values of a key
    in one version the largest counts, and ``copies`` says how many rows there were. Of
    ``bucketed`` rows neither aggregate shuffles.
    """
    counted = ~F.col("deleted")
    by_commit = rows.where(_until(second)).groupBy(*keys, "committed_at").agg(
        F.max(F.when(counted, F.col(value))).alias("_value"), F.count_if(counted).alias("_copies"))

    def at(moment: Moment, suffix: str) -> list[Column]:
        seen = F.when(_until(moment), F.col("committed_at"))
        return [F.max_by("_value", seen).alias(f"{value}_{suffix}"), F.max_by("_copies", seen).alias(f"copies_{suffix}")]

    sides = by_commit.groupBy(*keys).agg(*at(first, "v1"), *at(second, "v2"))
    return sides.where("copies_v1 > 0 AND copies_v2 > 0").withColumn(
        f"{value}_change", F.col(f"{value}_v2") - F.col(f"{value}_v1"))


def validity(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Every version of a row with the time it counted: from ``valid_from`` until before
    ``valid_to``, or on if that is NULL. Stored like this, a read as of a time is ``valid_at``, a
    filter. The window's work is linear in a key's versions, also in equal copies of one."""
    commit = F.unix_micros("committed_at")
    later = Window.partitionBy(*keys).orderBy(commit.desc()).rangeBetween(Window.unboundedPreceding, -1)
    closed = rows.withColumn("valid_to", F.timestamp_micros(F.min(commit).over(later)))
    return closed.where(~F.col("deleted")).withColumnRenamed("committed_at", "valid_from").drop("deleted")


def valid_at(intervals: DataFrame, moment: Moment = None) -> DataFrame:
    """What ``as_of`` says, from stored intervals: no shuffle and no aggregate."""
    at = F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")
    open_ = F.col("valid_to").isNull()
    counts = open_ if moment is None else (F.col("valid_from") <= at) & (open_ | (F.col("valid_to") > at))
    return intervals.where(counts).drop("valid_from", "valid_to")


def states(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The states of a table in order: when each became the current one and until when, how many row
    versions it began and ended, how many of those it began restore an earlier version of their key,
    as after a rollback, and how many rows it holds.

    There are no more states than commits; one that changed nothing ends and begins nothing."""
    own = [c for c in rows.columns if c not in (*keys, "committed_at", "deleted")]
    intervals = validity(rows, keys)
    one, two = _contents(own) if own else (F.lit(0), F.lit(0))
    before = Window.partitionBy(*keys, one, two).orderBy(F.unix_micros("valid_from")).rangeBetween(Window.unboundedPreceding, -1)
    intervals = intervals.withColumn("_again", (F.count("*").over(before) > 0).cast("int"))
    ends = intervals.select(F.explode(F.array(
        F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("begun"), F.lit(0).alias("ended"), F.col("_again").alias("restored")),
        F.struct(F.col("valid_to").alias("at"), F.lit(0).alias("begun"), F.lit(1).alias("ended"), F.lit(0).alias("restored")))).alias("e"))
    sums = ends.select("e.*").where("at IS NOT NULL").groupBy("at").agg(
        *[F.sum(c).alias(f"rows_{c}") for c in ("begun", "ended", "restored")])
    sums = sums.withColumn("_more", F.col("rows_begun") - F.col("rows_ended"))
    held = running_total(sums, [], ["at"], "_more", "rows_held", large=False)
    # one row for each commit
    return held.select(F.col("at").alias("current_from"), F.lead("at").over(Window.orderBy("at")).alias("current_until"),
                       "rows_begun", "rows_ended", "rows_restored", "rows_held")


def without_superseded(rows: DataFrame, before: Moment, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The rows that still count at ``before`` or later; reads as of earlier times are given up. A
    removal that is the newest up to then has nothing left to hide, and goes as well."""
    found = _newest(rows, keys, _kept=_until(before))
    late = ~_until(before)
    return found.where(late | (F.col("committed_at") == F.col("_kept")) & ~F.col("deleted")).drop("_kept")


def rewrite(rows: DataFrame, path: str, partitions: tuple[str, ...] = ("date",)) -> None:
    """Writes the folders of ``rows`` anew in few files of even size. The rows are staged
    first, so what is being replaced may be what they are read from."""
    overwrite_days(staged(rows, "rewrite"), path, partitions)
