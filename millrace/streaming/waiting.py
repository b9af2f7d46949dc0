"""Delayed retries as a table of waiting messages, partitioned by the interval in which they fall due.

A micro-batch reads the intervals that are due, delivers their messages together with the new ones,
stores what is done or dead, and writes what failed into the interval of its next attempt. Intervals
are folders, so only due ones are read, and a message is written once per attempt, whatever waits
beside it. No message is held in state, so none is dropped for being late.

A batch writes down the clock it has used before anything else. A repeat of the batch uses the same
clock and reads the same folders, as folders that a batch has emptied go only when the next batch
begins, after its commit. So a crash at any point loses nothing and delivers nothing twice into the
tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.keys import json_text
from millrace.operators.routing import ERROR_HEADER, MAX_RETRIES, RETRY_DELAY_MS, RETRY_HEADER, Handler, Rules, deliver_once, retry_wait_ms
from millrace.session import stored
from millrace.sources import files
from millrace.sources.keyed import write_batch

ARRIVAL_SCHEMA = "message_id bigint, body string, headers map<string,string>, delivered_at timestamp"
WAITING_SCHEMA = "message_id bigint, body string, retry_count bigint, last_error string, deliveries bigint, due_at timestamp, due bigint, batch_id bigint"
ENDED_SCHEMA = "message_id bigint, body string, target string, retry_count bigint, last_error string, deliveries bigint, delivered_at timestamp, batch_id bigint"
CLOCK_SCHEMA = "now timestamp, batch_id bigint"
DELIVERED = ("message_id", "body", "headers", "delivered_at", "deliveries", "previous_error")


class WaitingRoom:
    """The tables of a retry loop under one folder: ``waiting``, ``ended`` and ``clock``."""

    def __init__(self, spark: SparkSession, path: str, precision_ms: int = 1000):
        self.spark, self.path, self.precision_ms = spark, path, precision_ms
        for name in ("waiting", "ended", "clock"):
            files.make_folder(spark, f"{path}/{name}")

    def read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def waiting(self) -> DataFrame:
        return self.read("waiting", WAITING_SCHEMA)

    def ended(self) -> DataFrame:
        """Messages that are done or dead, one row each."""
        return self.read("ended", ENDED_SCHEMA)

    def due_interval(self, at):
        """Number of the interval that ends first at or after a time: its end, in steps of the precision."""
        micros, step = F.unix_micros(at), F.lit(self.precision_ms * 1000)
        return F.call_function("div", micros + F.pmod(-micros, step), step)

    def clock(self, batch: DataFrame, batch_id: int, live: bool):
        """The time this batch uses: the stored one where the batch is a repeat.

        Live it is the real time; else the latest delivery seen so far, which repeats with the data.
        """
        known = {row["batch_id"]: row["now"] for row in self.read("clock", CLOCK_SCHEMA).filter(F.col("batch_id") >= batch_id - 1).collect()}
        if batch_id not in known:
            seen = F.current_timestamp() if live else F.max("delivered_at")
            now = batch.agg(F.greatest(seen, F.lit(known.get(batch_id - 1)).cast("timestamp")).alias("now"))
            write_batch(now, f"{self.path}/clock", batch_id)
            known[batch_id] = self.read("clock", CLOCK_SCHEMA).filter(F.col("batch_id") == batch_id).first()["now"]
        return known[batch_id]

    def released(self, now, batch_id: int) -> list[tuple[int, int]]:
        """(interval, batch) folders that are due at ``now`` and were written by earlier batches."""
        if now is None:
            return []
        last = self.spark.range(1).select((F.unix_micros(F.lit(now).cast("timestamp")))).first()[0] // (self.precision_ms * 1000)
        folders = []
        for due in files.partition_values(self.spark, f"{self.path}/waiting", "due"):
            if int(due) <= last:
                own = files.partition_values(self.spark, files.partition_path(self.spark, f"{self.path}/waiting", "due", due), "batch_id")
                folders += [(int(due), int(b)) for b in own if int(b) < batch_id]
        return folders

    def forget(self, batch_id: int) -> None:
        """Drop what the batch before has delivered: its commit is certain once this batch begins."""
        before = self.read("clock", CLOCK_SCHEMA).filter(F.col("batch_id") == batch_id - 1).first()
        for due, written in self.released(before["now"], batch_id - 1) if before else []:
            files.drop_partition(self.spark, files.partition_path(self.spark, f"{self.path}/waiting", "due", str(due)), "batch_id", str(written))
        for old in files.partition_values(self.spark, f"{self.path}/clock", "batch_id"):
            if int(old) < batch_id - 1:
                files.drop_partition(self.spark, f"{self.path}/clock", "batch_id", old)

    def returned(self, folders: list[tuple[int, int]]) -> DataFrame:
        """Messages of some folders, as they enter the main queue again."""
        headers = F.create_map(F.lit(RETRY_HEADER), F.col("retry_count").cast("string"), F.lit(ERROR_HEADER), json_text(F.col("last_error")))
        rows = self.waiting().filter(F.col("due").isin(sorted({due for due, _ in folders})) & F.col("batch_id").isin(sorted({b for _, b in folders})))
        # A retry starts when its delay is over, not when the batch gets to it.
        return rows.select("message_id", "body", headers.alias("headers"), F.col("due_at").alias("delivered_at"), "deliveries", F.col("last_error").alias("previous_error"))


def loop_writer(room: WaitingRoom, handler: Handler | Rules, max_retries: int = MAX_RETRIES, delay_ms: int = RETRY_DELAY_MS, growth: int = 1, live: bool = True) -> Callable[[DataFrame, int], None]:
    """A batch callback for ``foreachBatch``: deliver new and due messages, store each outcome.

    An arrival without a message id is not a message; it only moves the clock. A message that ends
    ``done`` after failures keeps its last error, as ``final_outcomes`` does.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        room.forget(batch_id)
        now = room.clock(batch, batch_id, live)
        arrived = batch.filter(F.col("message_id").isNotNull()).withColumns({"deliveries": F.lit(0).cast("long"), "previous_error": F.lit(None).cast("string")})
        folders = room.released(now, batch_id)
        messages = arrived.select(*DELIVERED)
        if folders:
            messages = messages.unionByName(room.returned(folders))
        # Stored, so the handler runs once per delivery and both tables agree.
        routed = stored(deliver_once(messages, handler, max_retries).withColumn("deliveries", F.col("deliveries") + 1), "delivered")
        error = F.coalesce("last_error", "previous_error")
        ended = routed.filter("target <> 'retry'").select("message_id", "body", "target", "retry_count", error.alias("last_error"), "deliveries", "delivered_at")
        write_batch(ended, f"{room.path}/ended", batch_id)
        wait = retry_wait_ms(F.col("retry_count") - 1, delay_ms, growth)
        failed = routed.filter("target = 'retry'").withColumn("due_at", F.timestamp_add("MILLISECOND", wait, F.col("delivered_at")))
        waiting = failed.select("message_id", "body", "retry_count", "last_error", "deliveries", "due_at", room.due_interval(F.col("due_at")).alias("due"))
        waiting = waiting.withColumn("batch_id", F.lit(batch_id).cast("long"))
        waiting.hint("rebalance", "due").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("due", "batch_id").parquet(f"{room.path}/waiting")

    return write


def start_loop(arrivals: DataFrame, room: WaitingRoom, checkpoint: str, handler: Handler | Rules, once: bool = False, trigger: str = "1 second", **options) -> StreamingQuery:
    """Deliver arrivals (ARRIVAL_SCHEMA) and bring failed ones back until each is done or dead.

    Spark starts a micro-batch only when something has arrived. So live, arrivals are joined by a
    tick without a message each second, which lets due messages return in quiet times.
    """
    options.setdefault("live", not once)
    if options["live"]:
        ticks = arrivals.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
        empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in arrivals.schema}
        arrivals = arrivals.unionByName(ticks.select(*[F.col("timestamp").alias("delivered_at") if name == "delivered_at" else c for name, c in empty.items()]))
    writer = arrivals.writeStream.queryName("retry_loop").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.foreachBatch(loop_writer(room, handler, **options)).start()
