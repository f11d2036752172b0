"""Progress of streaming queries: the batches that Spark remembers, or all of them in Parquet."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_PROGRESS = ("query string, batch_id bigint, started_at string, input_rows bigint, "
             "input_rows_per_second double, processed_rows_per_second double, batch_ms bigint, "
             "watermark string, late_rows bigint")


def progress_frame(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """One row per recent micro-batch (Spark keeps a bounded number of them)."""
    rows = []
    for name, query in queries.items():
        for p in query.recentProgress:
            rows.append((
                name, p["batchId"], p["timestamp"], p["numInputRows"],
                p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"),
                p["durationMs"].get("triggerExecution"),
                p.get("eventTime", {}).get("watermark"),
                sum(s["numRowsDroppedByWatermark"] for s in p.get("stateOperators", []))))
    return spark.createDataFrame(rows, _PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every batch of every query to Parquet, ``every`` batches at a time and when a
    query ends. ``with ProgressLog(spark, path) as log`` listens inside the block; ``log.rows()`` reads."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self._waiting: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def flush(self) -> None:
        with self._changed:
            rows, self._waiting = self._waiting, []
        if rows:
            self.spark.createDataFrame(rows, _PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._changed:
            self._waiting.append((
                p.name or str(p.id), p.batchId, p.timestamp, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond,
                p.durationMs.get("triggerExecution"), (p.eventTime or {}).get("watermark"),
                sum(s.numRowsDroppedByWatermark for s in p.stateOperators)))
            full = len(self._waiting) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the end of a finished query has come through: events arrive after it."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.runId} was reported in {seconds} s")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_PROGRESS).parquet(self.path)
