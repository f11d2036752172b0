"""Quality reports over damaged ticks, and cleaning of damaged messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwell.functions.ticks import parse_messages as parse
from tickwell.functions.ticks import unreadable_times, with_event_time
from tickwell.operators import cleaning as C
from tickwell.operators import quality as Q
from tickwell.plans import frames as X
from tickwell.plans.frames import DIRTY, ISO, plain, with_ctes
from tickwell.plans.registry import query
from tickwell.schemas import RAW_VOLUMES, VOLUME_MESSAGE, VOLUMES_TABLE
from tickwell.session import fresh_dir
from tickwell.sources.days import write_days
from tickwell.streaming.pipelines import raw_volumes, rejected


def _dirty(spark, sf_dir):
    return X.dirty_ticks(spark, sf_dir).withColumns({
        "timestamp": F.col("event_timestamp"), "date": F.to_date("event_timestamp")})


def _null_sql(data_type: str, column: str) -> str:
    return f"""SELECT '{data_type}' AS data_type, date, '{column}_nulls' AS check_name, nulls AS value,
  round(nulls / n * 100, 8) AS percentage, nulls / n * 100 < 5 AS passed,
  printf('%d null values (%.2f%%)', nulls, nulls / n * 100) AS message,
  CASE WHEN nulls / n * 100 >= 5 THEN 'Too many nulls in {column}' END AS error
  FROM (SELECT date, count(*) AS n, count(*) - count({column}) AS nulls FROM rows GROUP BY date)"""


def _count_sql(data_type: str, name: str, condition: str, what: str) -> str:
    return f"""SELECT '{data_type}', date, '{name}', bad, NULL, bad = 0, bad || ' {what}',
  CASE WHEN bad > 0 THEN 'Found {what}' END
  FROM (SELECT date, count(*) FILTER ({condition}) AS bad FROM rows GROUP BY date)"""


def _records_sql(data_type: str) -> str:
    return f"""SELECT '{data_type}', date, 'record_count', count(*), NULL, TRUE,
  printf('Found %d records', count(*)), NULL FROM rows GROUP BY date"""


ROWS = "rows AS (SELECT *, event_timestamp AS timestamp, event_timestamp::DATE AS date FROM dirty)"
PRICE_CHECKS = " UNION ALL ".join([
    _null_sql("prices", "symbol"), _null_sql("prices", "price"), _null_sql("prices", "timestamp"),
    _records_sql("prices"), _count_sql("prices", "positive_prices", "price <= 0", "non-positive prices"),
    """SELECT 'prices', date, 'duplicates', dup, round(dup / n * 100, 8), dup / n * 100 < 10,
  printf('%d duplicate records (%.2f%%)', dup, dup / n * 100),
  CASE WHEN dup / n * 100 >= 10 THEN 'Too many duplicate records' END
  FROM (SELECT date, count(*) AS n, count(*) - count(DISTINCT (symbol, timestamp)) AS dup FROM rows GROUP BY date)"""])
VOLUME_CHECKS = " UNION ALL ".join([
    _null_sql("volumes", "symbol"), _null_sql("volumes", "volume"), _records_sql("volumes"),
    _count_sql("volumes", "non_negative_volumes", "volume < 0", "negative volumes")])


@query(with_ctes(DIRTY, ROWS, select=PRICE_CHECKS))
def dq_prices(spark, sf_dir):
    return plain(Q.price_report(_dirty(spark, sf_dir)), "percentage")


@query(with_ctes(DIRTY, ROWS, select=VOLUME_CHECKS))
def dq_volumes(spark, sf_dir):
    return plain(Q.volume_report(_dirty(spark, sf_dir)), "percentage")


@query(with_ctes(DIRTY, ROWS, f"report AS ({PRICE_CHECKS} UNION ALL {VOLUME_CHECKS})",
                 select="""SELECT data_type, date, bool_and(passed) AS passed,
  coalesce(string_agg(error, '; ' ORDER BY error), '') AS errors FROM report GROUP BY data_type, date"""))
def dq_verdict(spark, sf_dir):
    rows = _dirty(spark, sf_dir)
    verdicts = Q.verdict(Q.price_report(rows).unionAll(Q.volume_report(rows)))
    return verdicts.withColumn("errors", F.array_join("errors", "; "))


@query(with_ctes(DIRTY, ROWS, f"report AS ({PRICE_CHECKS} UNION ALL {VOLUME_CHECKS})",
                 select="SELECT date, bool_and(passed) AS passed FROM report GROUP BY date"))
def dq_verdict_overall(spark, sf_dir):
    rows = _dirty(spark, sf_dir)
    return Q.overall_verdict(Q.verdict(Q.price_report(rows).unionAll(Q.volume_report(rows))))


@query("""WITH t AS (SELECT l_orderkey AS symbol, l_linenumber AS timestamp FROM lineitem),
c AS (SELECT count(*) AS n, count(*) - count(DISTINCT (symbol, timestamp)) AS dup FROM t)
SELECT 'duplicates' AS check_name, dup AS value, round(dup / n * 100, 8) AS percentage,
  dup / n * 100 < 10 AS passed, CASE WHEN dup / n * 100 >= 10 THEN 'Too many duplicate records' END AS error FROM c""")
def dq_duplicates_trades(spark, sf_dir):
    """Order lines repeat their key often enough to fail the duplicate check."""
    lines = X.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("symbol"), F.col("l_linenumber").alias("timestamp"),
        F.col("l_extendedprice").alias("price"))
    report = Q.price_report(lines, "2001-12-31").filter(F.col("check_name") == "duplicates")
    return plain(report.select("check_name", "value", "percentage", "passed", "error"), "percentage")


@query(with_ctes(DIRTY, select="""SELECT column_name, expected_type, found_type,
  CASE column_name WHEN 'symbol' THEN (SELECT count(*) - count(symbol) FROM dirty)
    WHEN 'volume' THEN (SELECT count(*) - count(volume) FROM dirty) ELSE 0 END AS missing_values,
  same AND (column_name <> 'symbol' OR NOT EXISTS (FROM dirty WHERE symbol IS NULL))
       AND (column_name <> 'volume' OR NOT EXISTS (FROM dirty WHERE volume IS NULL)) AS passed
FROM (VALUES ('symbol', 'string', 'string', TRUE), ('timestamp', 'timestamp', 'timestamp_ntz', FALSE),
  ('date', 'date', 'date', TRUE), ('volume', 'bigint', 'bigint', TRUE), ('price', 'double', 'double', TRUE),
  ('tick_id', NULL, 'bigint', FALSE), ('event_timestamp', NULL, 'timestamp_ntz', FALSE),
  ('copy', NULL, 'int', FALSE), ('kafka_offset', NULL, 'bigint', FALSE))
  t(column_name, expected_type, found_type, same)"""))
def dq_schema(spark, sf_dir):
    return Q.schema_report(_dirty(spark, sf_dir), VOLUMES_TABLE)


# Parsing and cleaning of damaged messages ----------------------------------

PARSED = f"""parsed AS (
  SELECT symbol AS kafka_key, CAST(tick_id % 2 AS INT) AS kafka_partition, kafka_offset,
    event_timestamp AS kafka_timestamp,
    CASE WHEN NOT cut_short THEN symbol END AS symbol,
    CASE WHEN NOT cut_short THEN CASE WHEN bad_time THEN 'not-a-time' ELSE {ISO} END END AS timestamp,
    CASE WHEN NOT cut_short THEN volume END AS volume, CASE WHEN NOT cut_short THEN price END AS price,
    CASE WHEN NOT cut_short AND NOT bad_time THEN event_timestamp END AS event_timestamp
  FROM dirty)"""
REASON = """CASE WHEN symbol IS NULL AND timestamp IS NULL AND price IS NULL THEN 'malformed'
  WHEN symbol IS NULL THEN 'missing symbol' WHEN price IS NULL THEN 'missing price'
  WHEN price <= 0 THEN 'non-positive price' WHEN event_timestamp IS NULL THEN 'unreadable time' END"""
JUDGED = f"""judged AS (SELECT *, {REASON} AS bad FROM parsed),
ranked AS (SELECT *, CASE WHEN bad IS NULL AND row_number() OVER (
    PARTITION BY bad, symbol, event_timestamp ORDER BY kafka_offset DESC, kafka_partition DESC) > 1
    THEN 'duplicate' ELSE bad END AS reason FROM judged)"""


def _parsed(spark, sf_dir):
    return with_event_time(parse(X.dirty_messages(spark, sf_dir), VOLUME_MESSAGE))


@query(with_ctes(DIRTY, PARSED, select="""SELECT kafka_key, kafka_partition, kafka_offset, kafka_timestamp,
  symbol, timestamp, volume, price FROM parsed"""))
def parse_messages(spark, sf_dir):
    return plain(parse(X.dirty_messages(spark, sf_dir), VOLUME_MESSAGE))


@query(with_ctes(DIRTY, PARSED, select="SELECT kafka_offset, timestamp, event_timestamp FROM parsed"))
def parse_event_time(spark, sf_dir):
    return plain(_parsed(spark, sf_dir).select("kafka_offset", "timestamp", "event_timestamp"))


@query(with_ctes(DIRTY, PARSED, select="""SELECT count(*) AS records, count(*) FILTER (
  timestamp IS NOT NULL AND event_timestamp IS NULL) AS unreadable FROM parsed"""))
def unreadable_event_times(spark, sf_dir):
    return _parsed(spark, sf_dir).agg(F.count("*").alias("records"), unreadable_times().alias("unreadable"))


@query(with_ctes(DIRTY, PARSED, JUDGED, select="""SELECT kafka_partition, kafka_offset, symbol, event_timestamp,
  volume, price FROM ranked WHERE reason IS NULL"""))
def clean_ticks(spark, sf_dir):
    clean = C.clean_ticks(_parsed(spark, sf_dir))
    return plain(clean.select("kafka_partition", "kafka_offset", "symbol", "event_timestamp", "volume", "price"))


@query(with_ctes(DIRTY, PARSED, JUDGED, select="""SELECT kafka_partition, kafka_offset, reason
  FROM ranked WHERE reason IS NOT NULL"""))
def quarantine_ticks(spark, sf_dir):
    return C.quarantine(_parsed(spark, sf_dir)).select("kafka_partition", "kafka_offset", "reason")


# A stored day ----------------------------------------------------------------

STORED_DAY = f"""arrived AS (SELECT *, {REASON} AS bad FROM parsed),
rows AS (SELECT *, event_timestamp::DATE AS date FROM arrived
  WHERE bad IS NULL AND event_timestamp::DATE = DATE '2024-01-15'),
lost AS (SELECT count(*) AS r, (SELECT count(*) FROM rows) AS n FROM arrived
  WHERE bad IS NOT NULL AND kafka_timestamp::DATE = DATE '2024-01-15')"""
REJECTED = """SELECT 'volumes', DATE '2024-01-15', 'rejected_messages', r, round(r / (n + r) * 100, 8),
  r / (n + r) * 100 < 5, printf('%d rejected messages (%.2f%%)', r, round_even(r / (n + r) * 100, 2)),
  CASE WHEN r / (n + r) * 100 >= 5 THEN 'Too many rejected messages' END FROM lost"""


@query(with_ctes(DIRTY, PARSED, STORED_DAY, select=f"{VOLUME_CHECKS} UNION ALL {REJECTED}"))
def dq_stored_day(spark, sf_dir):
    """The report of a stored day as the job makes it, with the messages that were not stored."""
    messages = X.dirty_messages(spark, sf_dir)
    root, lost = fresh_dir(spark, "dirty-raw"), fresh_dir(spark, "dirty-rejects")
    write_days(raw_volumes(messages), root)
    write_days(rejected(messages), lost)
    return plain(Q.day_report(spark, root, RAW_VOLUMES, "volumes", "2024-01-15", lost), "percentage")
