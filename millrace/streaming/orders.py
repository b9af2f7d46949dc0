"""The order job: revenue windows and dead letters from one message log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.decode import dead_letters, decode_orders, valid_orders
from millrace.operators.revenue import revenue_by_window
from millrace.sources.keyed import insert_writer, upsert_writer

WINDOW = "1 minute"
WATERMARK = "1 minute"
TRIGGER = "15 seconds"


def _start(writer, checkpoint: str, once: bool, trigger: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)).start()


def start_revenue(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    trigger: str = TRIGGER,
    once: bool = False,
    unique_orders: bool = False,
) -> StreamingQuery:
    """Keep the revenue table up to date: every trigger re-emits the windows it changed.

    The number of state partitions is fixed by spark.sql.shuffle.partitions at the first start.
    ``unique_orders`` drops repeats of an order id that arrive within the watermark.
    """
    orders = valid_orders(decode_orders(messages))
    if unique_orders:
        orders = orders.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["order_id"])
        revenue = revenue_by_window(orders, window)
    else:
        revenue = revenue_by_window(orders, window, watermark)
    writer = revenue.writeStream.queryName("revenue").outputMode("update").foreachBatch(upsert_writer(table))
    return _start(writer, checkpoint, once, trigger)


def start_dead_letters(
    messages: DataFrame, table: str, checkpoint: str, trigger: str = TRIGGER, once: bool = False
) -> StreamingQuery:
    """Store malformed events. Reads the log with its own offsets, so neither query holds up the other."""
    dead = dead_letters(decode_orders(messages))
    writer = dead.writeStream.queryName("dead_letters").outputMode("append").foreachBatch(insert_writer(table))
    return _start(writer, checkpoint, once, trigger)


def run(
    spark: SparkSession, messages: DataFrame, tables: str, checkpoints: str, timeout: int | None = None, **options
) -> None:
    """Run both queries until either one stops, then stop the other; a failure is raised.

    With ``once`` both work through what there is, and the job ends when both have. ``trigger`` and
    ``once`` hold for both queries, the other options for revenue.
    """
    # Queries that ended earlier in this session must not end this job.
    spark.streams.resetTerminated()
    queries = [
        start_revenue(messages, f"{tables}/revenue", f"{checkpoints}/revenue", **options),
        start_dead_letters(
            messages,
            f"{tables}/dead_letters",
            f"{checkpoints}/dead_letters",
            **{name: value for name, value in options.items() if name in ("trigger", "once")},
        ),
    ]
    try:
        if options.get("once"):
            for query in queries:
                query.awaitTermination(timeout)
        else:
            spark.streams.awaitAnyTermination(timeout)
    finally:
        for query in queries:
            query.stop()
