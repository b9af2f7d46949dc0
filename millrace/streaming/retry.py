"""Delayed retries: hold failed messages in keyed state until they are due."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.keys import json_text
from millrace.operators.routing import (
    ERROR_HEADER,
    MAX_RETRIES,
    RETRY_DELAY_MS,
    RETRY_HEADER,
    Handler,
    deliver_once,
    retry_wait_ms,
)
from millrace.sources import files
from millrace.sources.keyed import write_batch

DUE_SCHEMA = "message_id bigint, body string, retry_count bigint, last_error string, due_at timestamp"
DUE_COLUMNS = [part.split()[0] for part in DUE_SCHEMA.split(", ")]
HELD_COLUMNS = ["message_id", "body", "retry_count", "last_error", "due_us"]


def _hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, live: bool) -> Iterator[pd.DataFrame]:
    """Messages that fall due together: keep them until the clock has reached ``release_ms``."""
    _, release_ms = key
    held = {row[0]: row for row in json.loads(state.get[0])} if state.exists else {}
    if state.hasTimedOut:
        state.remove()
    else:
        for batch in batches:
            known = batch[batch["message_id"].notna()]
            for row in zip(*(known[name].tolist() for name in HELD_COLUMNS)):
                message_id = int(row[0])
                # A repeated message replaces its copy unless that is further along.
                if message_id not in held or held[message_id][2] <= row[2]:
                    held[message_id] = (message_id, row[1], int(row[2]), row[3], int(row[4]))
        now_ms = state.getCurrentProcessingTimeMs() if live else state.getCurrentWatermarkMs()
        if release_ms > now_ms:
            state.update((json.dumps(list(held.values())),))
            if live:
                state.setTimeoutDuration(int(release_ms - now_ms))
            else:
                state.setTimeoutTimestamp(int(release_ms))
            return
        if state.exists:
            state.remove()
    if held:
        due = pd.DataFrame(list(held.values()), columns=HELD_COLUMNS)
        due["due_at"] = pd.to_datetime(due["due_us"], unit="us")
        yield due[DUE_COLUMNS]


def delayed_retries(
    failed: DataFrame,
    delay_ms: int = RETRY_DELAY_MS,
    growth: int = 1,
    clock: str = "processing",
    watermark: str = "1 minute",
    precision_ms: int = 1000,
    shards: int | None = None,
) -> DataFrame:
    """Failed messages (message_id, body, retry_count, last_error, failed_at) when their delay is over.

    With the ``processing`` clock a message comes back when real time has passed its due time,
    rounded up to ``precision_ms``; no message is dropped, and one that is already due comes
    straight back. With the ``event`` clock the watermark over ``failed_at`` decides, which makes
    a replay of old messages repeatable; Spark then drops messages further behind than
    ``watermark`` and counts them in the query's progress. A row without a message id only moves
    the event clock.

    Messages that fall due in the same interval wait in one state row per shard, so the cost of
    a state row is shared and a burst spreads over ``shards`` of them (as many as there are state
    partitions unless given).
    """
    if clock not in ("processing", "event"):
        raise ValueError(f"unknown clock {clock!r}; use 'processing' or 'event'")
    live = clock == "processing"
    partitions = int(failed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wait = retry_wait_ms(F.col("retry_count") - 1, delay_ms, growth)
    step_us = precision_ms * 1000
    rounded_up = F.col("due_us") + F.pmod(-F.col("due_us"), F.lit(step_us))
    shard = F.pmod(F.xxhash64("message_id"), F.lit(shards or partitions))
    timed = failed if live else failed.withWatermark("failed_at", watermark)
    placed = (
        timed.withColumn("due_us", F.unix_micros(F.col("failed_at")) + wait * 1000)
        .withColumn("rounded_up_us", rounded_up)
        .withColumn("release_ms", F.coalesce(F.expr("rounded_up_us div 1000"), F.lit(0).cast("long")))
        .withColumn("shard", F.when(F.col("message_id").isNull(), F.lit(-1)).otherwise(shard))
    )

    def hold(key, batches, state):
        return _hold(key, batches, state, live)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if live else GroupStateTimeout.EventTimeTimeout
    return (
        placed.select("shard", "release_ms", "failed_at", *HELD_COLUMNS)
        .groupBy("shard", "release_ms")
        .applyInPandasWithState(hold, DUE_SCHEMA, "held string", "append", timeout)
    )


MESSAGE_SCHEMA = "message_id bigint, body string, headers map<string,string>"
OUTCOME_SCHEMA = (
    "message_id bigint, body string, target string, retry_count bigint, last_error string, "
    "headers string, routed_at timestamp, batch_id bigint"
)


def outcome_writer(
    path: str, handler: Handler, max_retries: int = MAX_RETRIES
) -> Callable[[DataFrame, int], None]:
    """A batch callback for ``foreachBatch``: route a batch of messages into done, retry and dead.

    All targets are written before the batch's offsets are committed, so a message is never
    released before its copy is stored; a crash in between repeats the batch, which rewrites it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = deliver_once(batch, handler, max_retries)
        # One write, so the handler runs once per message and the three targets agree.
        stamped = routed.withColumn("headers", F.to_json("headers")).withColumn("routed_at", F.current_timestamp())
        write_batch(stamped, path, batch_id)

    return write


def returned_messages(due: DataFrame) -> DataFrame:
    """Messages whose delay is over, as they enter the main queue again."""
    headers = F.create_map(
        F.lit(RETRY_HEADER), F.col("retry_count").cast("string"), F.lit(ERROR_HEADER), json_text(F.col("last_error"))
    )
    return due.select("message_id", "body", headers.alias("headers"))


def start_router(
    arrivals: DataFrame,
    tables: str,
    checkpoint: str,
    handler: Handler,
    max_retries: int = MAX_RETRIES,
    trigger: str = "15 seconds",
) -> StreamingQuery:
    """Deliver new messages and returned ones, and store each outcome under ``tables``."""
    spark = arrivals.sparkSession
    files.make_folder(spark, f"{tables}/returned")
    returned = spark.readStream.schema(f"{MESSAGE_SCHEMA}, batch_id bigint").parquet(f"{tables}/returned")
    messages = arrivals.select("message_id", "body", "headers").unionByName(returned.drop("batch_id"))
    write = outcome_writer(f"{tables}/outcomes", handler, max_retries)
    writer = messages.writeStream.queryName("router").option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=trigger).foreachBatch(write).start()


def start_returns(
    spark: SparkSession,
    tables: str,
    checkpoint: str,
    delay_ms: int = RETRY_DELAY_MS,
    growth: int = 1,
    trigger: str = "1 second",
) -> StreamingQuery:
    """Bring messages in ``retry`` back to the router when their delay is over."""
    files.make_folder(spark, f"{tables}/outcomes")
    outcomes = spark.readStream.schema(OUTCOME_SCHEMA).parquet(f"{tables}/outcomes").filter("target = 'retry'")
    failed = outcomes.select(
        "message_id", "body", "retry_count", "last_error", F.col("routed_at").alias("failed_at")
    )
    due = delayed_retries(failed, delay_ms, growth)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(returned_messages(batch), f"{tables}/returned", batch_id)

    writer = due.writeStream.queryName("returns").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=trigger).foreachBatch(write).start()
