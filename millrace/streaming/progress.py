"""Progress of running queries as rows, and alerts on them."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, batch_id bigint, at timestamp, input_rows bigint, input_rate double, "
    "processed_rate double, batch_ms bigint, watermark timestamp, late_rows bigint, state_rows bigint, offsets_behind bigint"
)


def _row(progress: dict) -> str:
    states = progress.get("stateOperators") or []
    event_time = progress.get("eventTime") or {}
    # A message-log source reports how far it is behind; a file source does not.
    metrics = [source.get("metrics") or {} for source in progress.get("sources") or []]
    behind = [int(one["maxOffsetsBehindLatest"]) for one in metrics if "maxOffsetsBehindLatest" in one]
    return json.dumps(
        {
            "query": progress.get("name") or progress.get("id"),
            "batch_id": progress["batchId"],
            "at": progress["timestamp"],
            "input_rows": progress.get("numInputRows", 0),
            "input_rate": progress.get("inputRowsPerSecond"),
            "processed_rate": progress.get("processedRowsPerSecond"),
            "batch_ms": (progress.get("durationMs") or {}).get("triggerExecution"),
            "watermark": event_time.get("watermark"),
            "late_rows": sum(state.get("numRowsDroppedByWatermark", 0) for state in states),
            "state_rows": sum(state.get("numRowsTotal", 0) for state in states),
            "offsets_behind": max(behind, default=None),
        }
    )


def _frame(spark: SparkSession, rows: list[str]) -> DataFrame:
    parsed = spark.createDataFrame([(row,) for row in rows], "line string")
    return parsed.select(F.inline(F.array(F.from_json("line", PROGRESS_SCHEMA))))


def recent_progress(query: StreamingQuery) -> DataFrame:
    """The progress a query still remembers, one row per micro-batch."""
    rows = [_row(json.loads(progress.json)) for progress in query.recentProgress]
    return _frame(SparkSession.active(), rows)


class ProgressTable(StreamingQueryListener):
    """Appends the progress of every query of a session to a table, one small row per micro-batch."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self.waiting: list[str] = []
        self.heard: dict[str, int] = {}
        self.writing = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        self.waiting.append(_row(progress))
        self.heard[progress["runId"]] = progress["batchId"]
        if len(self.waiting) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self.writing:  # events come on a thread of their own
            rows, self.waiting = self.waiting, []
            if rows:
                _frame(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)


    def caught_up(self, query: StreamingQuery, seconds: float = 60) -> DataFrame:
        """The table once it has all that an ended query reported; progress reaches listeners with a delay."""
        last, deadline = json.loads(query.lastProgress.json), time.monotonic() + seconds
        while self.heard.get(last["runId"], -1) < last["batchId"]:
            if time.monotonic() > deadline:
                raise TimeoutError(f"batch {last['batchId']} of {query.name or query.id} was not heard of in {seconds} s")
            time.sleep(0.1)
        self.flush()
        return self.read()

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)


def late_rows(progress: DataFrame) -> DataFrame:
    """Rows dropped for being late per query and micro-batch, where there were any.

    Spark counts what reaches the state: of a windowed sum, one row per window and key.
    """
    return progress.groupBy("query", "batch_id").agg(F.sum("late_rows").alias("late_rows")).filter("late_rows > 0")


def lag_by_batch(progress: DataFrame, landed_rows: int) -> DataFrame:
    """Per query and micro-batch with input: rows taken in, and how many of the log's rows were still ahead.

    The running sum goes over one row per micro-batch.
    """
    so_far = Window.partitionBy("query").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    taken = progress.groupBy("query", "batch_id").agg(F.sum("input_rows").alias("input_rows")).filter("input_rows > 0")
    return taken.withColumn("behind", F.lit(landed_rows) - F.sum("input_rows").over(so_far))


def late_alerts(progress: DataFrame, limit: int = 0) -> DataFrame:
    """Micro-batches in which more than ``limit`` rows were dropped for being late."""
    return progress.filter(F.col("late_rows") > limit)


def lag_alerts(progress: DataFrame, offsets: int = 0) -> DataFrame:
    """Micro-batches that took in rows faster than they processed them, or ended too far behind."""
    return progress.filter((F.col("input_rate") > F.col("processed_rate")) | (F.col("offsets_behind") > offsets))
