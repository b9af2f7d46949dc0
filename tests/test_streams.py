"""Streams: late rows, restarts, replays, the two-query job, delayed retries, progress."""

import json
import time
from datetime import datetime, timedelta, timezone

import pytest

from millrace.plans.handlers import ORDER_RULES
from millrace.operators.ttl import CachePolicy
from millrace.plans.replayed import replay
from millrace.sources import keyed, messages
from millrace.streaming import lookup, orders, progress, retry
from millrace.streaming.drain import drain

MIDNIGHT = datetime(2024, 1, 1)


def order(product, minute, second=0, order_id="o"):
    at = MIDNIGHT + timedelta(minutes=minute, seconds=second)
    return json.dumps({"order_id": order_id, "product": product, "price": 1.0, "quantity": 1, "ts": at.isoformat() + "+00:00"})


def frames(spark, *batches):
    offset = 0
    for values in batches:
        rows = [("orders", 0, offset + place, value) for place, value in enumerate(values)]
        offset += len(values)
        yield spark.createDataFrame(rows, messages.MESSAGE_SCHEMA).coalesce(1)


def revenue_after(spark, folder, batches, per_run=True, **options):
    """Counts by (minute, product) after feeding the batches, and the last query."""
    base = folder("revenue")
    seen = []

    def start():
        stream = messages.file_stream(spark, f"{base}/in", files_per_trigger=1)
        query = orders.start_revenue(stream, f"{base}/table", f"{base}/checkpoint", once=True, **options)
        seen.append(query)
        return query

    if per_run:
        replay(batches, f"{base}/in", start, 120)
    else:
        for batch in batches:
            messages.land_files(batch, f"{base}/in")
        drain(start(), 120)
    rows = keyed.read_latest(spark, f"{base}/table").collect()
    return {(row["window_start"].minute, row["product"]): row["orders_count"] for row in rows}, seen


def test_restarts_equal_one_run(spark, folder):
    batches = [[order("a", 0), order("b", 0), "junk"], [order("a", 0, 30), order("a", 3)], [order("b", 5)]]
    restarted, _ = revenue_after(spark, folder, list(frames(spark, *batches)))
    through, _ = revenue_after(spark, folder, list(frames(spark, *batches)), per_run=False)
    assert restarted == through == {(0, "a"): 2, (0, "b"): 1, (3, "a"): 1, (5, "b"): 1}


def test_rows_below_the_watermark_are_dropped_and_counted(spark, folder):
    batches = [[order("a", 0)], [order("a", 30)], [order("a", 31)], [order("a", 0, 30)], [order("a", 32)]]
    counts, queries = revenue_after(spark, folder, list(frames(spark, *batches)))
    assert counts[(0, "a")] == 1
    late = [row["late_rows"] for query in queries for row in progress.recent_progress(query).collect()]
    assert sum(late) == 1
    # Negative control: with a generous watermark the same row counts.
    counts, _ = revenue_after(spark, folder, list(frames(spark, *batches)), watermark="1 hour")
    assert counts[(0, "a")] == 2


def test_repeated_orders_are_dropped_on_request(spark, folder):
    batches = [[order("a", 0, 1, "x"), order("a", 0, 2, "x")], [order("a", 0, 3, "x"), order("a", 0, 4, "y")]]
    assert revenue_after(spark, folder, list(frames(spark, *batches)))[0] == {(0, "a"): 4}
    assert revenue_after(spark, folder, list(frames(spark, *batches)), unique_orders=True)[0] == {(0, "a"): 2}


def test_job_survives_malformed_events(spark, folder):
    base = folder("job")
    no_product = '{"order_id": "o", "price": 10.0, "quantity": 1, "ts": "2024-01-01T00:00:00+00:00"}'
    no_time = '{"order_id": "o", "product": "bad", "price": 10.0, "quantity": 1}'
    (batch,) = frames(spark, ["this is not json", no_product, no_time, '{"product": "p", "price": NaN}', order("good", 0)])
    messages.land_files(batch, f"{base}/in")
    stream = messages.message_stream(spark, "files", path=f"{base}/in")
    drain(orders.start_revenue(stream, f"{base}/revenue", f"{base}/c1", once=True), 120)
    drain(orders.start_dead_letters(stream, f"{base}/dead", f"{base}/c2", once=True), 120)
    assert [row["product"] for row in keyed.read_latest(spark, f"{base}/revenue").collect()] == ["good"]
    assert keyed.read_first(spark, f"{base}/dead").count() == 4


def test_job_stops_when_one_query_stops(spark, folder):
    base = folder("job")
    (batch,) = frames(spark, [order("a", 0), "junk"])
    messages.land_files(batch, f"{base}/in")
    stream = messages.message_stream(spark, "files", path=f"{base}/in")
    orders.run(spark, stream, f"{base}/tables", f"{base}/checkpoints", timeout=120, once=True)
    assert spark.streams.active == []
    assert keyed.read_latest(spark, f"{base}/tables/revenue").count() == 1


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError, match="unknown message source"):
        messages.message_stream(spark, "carrier pigeon")


RETRY_SCHEMA = "message_id bigint, body string, retry_count bigint, last_error string, failed_at timestamp"


def test_retries_come_back_after_their_delay(spark, folder):
    base = folder("retry")

    def start():
        stream = messages.file_stream(spark, f"{base}/in", schema=RETRY_SCHEMA)
        writer = retry.delayed_retries(stream, delay_ms=60_000, growth=2, clock="event", watermark="0 seconds").writeStream.outputMode("append")
        return writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{base}/out")

    def returned():
        return {row["message_id"]: (row["retry_count"], row["due_at"]) for row in spark.read.parquet(f"{base}/out").collect()}

    def clock(minute):
        return spark.createDataFrame([(None, None, None, None, MIDNIGHT + timedelta(minutes=minute))], RETRY_SCHEMA)

    waiting = spark.createDataFrame([(1, "b", 1, "e", MIDNIGHT), (2, "b", 2, "e", MIDNIGHT)], RETRY_SCHEMA)
    replay([waiting, clock(1.5)], f"{base}/in", start, 120)
    assert returned() == {1: (1, MIDNIGHT + timedelta(minutes=1))}
    replay([clock(3)], f"{base}/in", start, 120)
    assert returned()[2] == (2, MIDNIGHT + timedelta(minutes=2))


def test_repeated_failure_comes_back_once(spark, folder):
    base = folder("repeated")

    def start():
        stream = messages.file_stream(spark, f"{base}/in", schema=RETRY_SCHEMA)
        due = retry.delayed_retries(stream, delay_ms=60_000, clock="event", watermark="5 seconds", shards=1)
        writer = due.writeStream.outputMode("append").option("checkpointLocation", f"{base}/checkpoint")
        return writer.trigger(availableNow=True).format("parquet").start(f"{base}/out")

    def failed(*rows):
        return spark.createDataFrame([(number, "b", count, "e", MIDNIGHT + timedelta(minutes=at)) for number, count, at in rows], RETRY_SCHEMA)

    replay([failed((1, 1, 10)), failed((2, 1, 10), (1, 1, 10)), failed((4, 1, 20))], f"{base}/in", start, 120)
    assert sorted(row["message_id"] for row in spark.read.parquet(f"{base}/out").collect()) == [1, 2]


def test_live_clock_returns_old_and_new_messages(spark, folder):
    """Messages far behind come straight back; a fresh one waits. Nothing is dropped as late."""
    base = folder("live")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(1, "b", 1, "e", now), (2, "b", 1, "e", MIDNIGHT)]
    messages.land_files(spark.createDataFrame(rows, RETRY_SCHEMA), f"{base}/in")
    stream = messages.file_stream(spark, f"{base}/in", schema=RETRY_SCHEMA)
    due = retry.delayed_retries(stream, delay_ms=4000, precision_ms=500)
    writer = due.writeStream.outputMode("append").option("checkpointLocation", f"{base}/checkpoint")
    query = writer.trigger(processingTime="500 milliseconds").format("parquet").start(f"{base}/out")
    try:
        deadline = time.monotonic() + 90
        found = []
        while len(found) < 2 and time.monotonic() < deadline:
            time.sleep(1)
            if keyed.files.exists(spark, f"{base}/out/_spark_metadata"):
                found = spark.read.schema(retry.DUE_SCHEMA).parquet(f"{base}/out").collect()
    finally:
        query.stop()
    assert sorted(row["message_id"] for row in found) == [1, 2]


def test_retry_loop_ends_every_message(spark, folder):
    """New messages are delivered, failed ones return after a delay, and each ends done or dead."""
    base = folder("loop")
    bodies = {
        1: '{"order_id": "order-1"}',
        2: '{"order_id": "order-2", "simulate_failures": 2}',
        3: '{"order_id": "order-3", "simulate_failures": 99}',
        4: "{this is not json",
    }
    rows = [(number, body, {}) for number, body in bodies.items()] + [(5, bodies[1], {"x-retry-count": '"bad"'})]
    messages.land_files(spark.createDataFrame(rows, retry.MESSAGE_SCHEMA), f"{base}/in")
    arrivals = messages.file_stream(spark, f"{base}/in", schema=retry.MESSAGE_SCHEMA)
    queries = [
        retry.start_router(arrivals, f"{base}/tables", f"{base}/c1", ORDER_RULES, trigger="1 second"),
        retry.start_returns(spark, f"{base}/tables", f"{base}/c2", delay_ms=1000),
    ]

    def ended():
        outcomes = spark.read.schema(retry.OUTCOME_SCHEMA).parquet(f"{base}/tables/outcomes")
        return {row["message_id"]: row for row in outcomes.filter("target <> 'retry'").collect()}

    found = {}
    try:
        deadline = time.monotonic() + 240
        while len(found) < 5 and time.monotonic() < deadline:
            time.sleep(2)
            assert all(query.exception() is None for query in queries)
            found = ended()
    finally:
        for query in queries:
            query.stop()
    assert {number: row["target"] for number, row in found.items()} == {1: "done", 2: "done", 3: "dead", 4: "dead", 5: "dead"}
    assert {number: row["retry_count"] for number, row in found.items()} == {1: 0, 2: 2, 3: 3, 4: 0, 5: 0}
    stored = spark.read.schema(retry.OUTCOME_SCHEMA).parquet(f"{base}/tables/outcomes")
    assert stored.filter("message_id = 3").count() == 4


def test_unknown_clock_is_refused(spark):
    with pytest.raises(ValueError, match="unknown clock"):
        retry.delayed_retries(spark.createDataFrame([], RETRY_SCHEMA), clock="sundial")


def test_cache_state_survives_a_restart(spark, folder):
    base = folder("ttl")
    schema = "key bigint, ts timestamp, seq bigint, is_read boolean"

    def start():
        stream = messages.file_stream(spark, f"{base}/in", schema=schema)
        writer = lookup.ttl_status_stream(stream, CachePolicy(ttl=timedelta(seconds=30))).writeStream.outputMode("append")
        return writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{base}/out")

    def requests(*rows):
        return spark.createDataFrame([(7, MIDNIGHT + timedelta(seconds=at), at, is_read) for at, is_read in rows], schema)

    replay([requests((0, True), (10, True)), requests((20, True), (21, False)), requests((22, True), (60, True))], f"{base}/in", start, 120)
    rows = {row["seq"]: row["status"] for row in spark.read.parquet(f"{base}/out").collect()}
    assert rows == {0: "miss", 10: "hit", 20: "hit", 22: "miss", 60: "miss"}


def test_progress_table_and_alerts(spark, folder):
    path = folder("progress")
    table = progress.ProgressTable(spark, path, every=1)
    spark.streams.addListener(table)
    try:
        revenue_after(spark, folder, list(frames(spark, [order("a", 0)])))
        for _ in range(100):
            if keyed.files.exists(spark, f"{path}/_SUCCESS"):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(table)
    rows = spark.read.parquet(path)
    assert rows.filter("query = 'revenue' AND input_rows > 0").count() >= 1
    assert progress.late_alerts(rows).count() == 0
