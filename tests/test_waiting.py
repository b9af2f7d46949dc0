"""The retry loop over a table of waiting messages: repeats, conservation, late rows, quiet times."""

import time
from datetime import datetime, timedelta

import pytest

from millrace.plans.handlers import ORDER_RULES
from millrace.sources import messages
from millrace.streaming import waiting

START = datetime(2024, 1, 1)


def batch(spark, *rows):
    """(message_id, failures, seconds after START); a negative number of failures is poison."""
    bodies = [(n, "[]" if f is not None and f < 0 else f'{{"order_id": "o{n}", "simulate_failures": {f}}}', {}, START + timedelta(seconds=s)) for n, f, s in rows]
    return spark.createDataFrame(bodies, waiting.ARRIVAL_SCHEMA)


def tick(spark, seconds):
    return spark.createDataFrame([(None, None, None, START + timedelta(seconds=seconds))], waiting.ARRIVAL_SCHEMA)


def ends(room):
    return {r["message_id"]: (r["target"], r["deliveries"], r["retry_count"]) for r in room.ended().collect()}


def held(room):
    return sorted((r["message_id"], r["retry_count"]) for r in room.waiting().collect())


def test_messages_return_when_their_interval_is_due(spark, folder):
    room = waiting.WaitingRoom(spark, folder("room"))
    write = waiting.loop_writer(room, ORDER_RULES, live=False)
    write(batch(spark, (1, 0, 0), (2, 1, 0), (3, 99, 0), (4, -1, 0)), 0)
    assert ends(room) == {1: ("done", 1, 0), 4: ("dead", 1, 0)}
    write(tick(spark, 2), 1)  # a second too early
    assert held(room) == [(2, 1), (3, 1)]
    write(tick(spark, 3), 2)
    write(tick(spark, 6), 3)
    write(tick(spark, 9), 4)
    write(tick(spark, 9), 5)
    assert ends(room) == {1: ("done", 1, 0), 2: ("done", 2, 1), 3: ("dead", 4, 3), 4: ("dead", 1, 0)}
    assert held(room) == []


def test_a_repeated_batch_changes_nothing(spark, folder):
    """Each batch runs twice, as after a crash before its commit, the second time with later rows to tempt it."""
    room = waiting.WaitingRoom(spark, folder("room"))
    write = waiting.loop_writer(room, ORDER_RULES, live=False)
    rows = [(n, n % 6, n) for n in range(40)]
    for batch_id in range(12):
        for _ in range(2):
            write(batch(spark, *[r for r in rows if r[2] // 4 == batch_id]).unionByName(tick(spark, 4 * batch_id + 3)), batch_id)
    for batch_id in range(12, 16):
        write(tick(spark, 1000 * batch_id), batch_id)
    assert room.ended().count() == 40
    assert ends(room) == {n: ("done", n % 6 + 1, n % 6) if n % 6 <= 3 else ("dead", 4, 3) for n in range(40)}


def test_received_is_done_dead_and_waiting_after_every_batch(spark, folder):
    room = waiting.WaitingRoom(spark, folder("room"))
    write = waiting.loop_writer(room, ORDER_RULES, live=False)
    received = 0
    for batch_id in range(4):
        rows = [(100 * batch_id + n, n % 6, batch_id) for n in range(12)]
        write(batch(spark, *rows), batch_id)
        received += 12
        # Folders that this batch has delivered go with the next one; they no longer wait.
        gone = {(d, b) for d, b in room.released(START + timedelta(seconds=batch_id), batch_id)}
        left = [r for r in room.waiting().collect() if (r["due"], r["batch_id"]) not in gone]
        assert room.ended().count() + len(left) == received


def test_a_message_far_behind_the_clock_is_not_dropped(spark, folder):
    room = waiting.WaitingRoom(spark, folder("room"))
    write = waiting.loop_writer(room, ORDER_RULES, live=False)
    write(batch(spark, (1, 0, 1_000_000)), 0)
    write(batch(spark, (2, 1, 0)), 1)
    write(tick(spark, 0), 2)
    assert ends(room) == {1: ("done", 1, 0), 2: ("done", 2, 1)}


@pytest.mark.parametrize("micros, interval", [(0, 0), (1, 1), (1_000_000, 1), (1_000_001, 2), (-1, 0), (-1_000_000, -1)])
def test_an_interval_ends_at_or_after_its_times(spark, folder, micros, interval):
    from pyspark.sql import functions as F

    room = waiting.WaitingRoom(spark, folder("room"))
    assert spark.range(1).select(room.due_interval(F.timestamp_micros(F.lit(micros)))).first()[0] == interval


def test_waiting_messages_return_in_quiet_times(spark, folder):
    """One arrival and then none: ticks bring the message back until it ends, here after two retries."""
    base = folder("live")
    now = datetime.now()
    messages.land_files(batch(spark, (1, 2, 0)).selectExpr("message_id", "body", "headers", f"timestamp'{now}' AS delivered_at"), f"{base}/in")
    room = waiting.WaitingRoom(spark, f"{base}/tables")
    arrivals = messages.file_stream(spark, f"{base}/in", schema=waiting.ARRIVAL_SCHEMA)
    query = waiting.start_loop(arrivals, room, f"{base}/checkpoint", ORDER_RULES, delay_ms=500)
    try:
        deadline = time.monotonic() + 150
        while not ends(room) and time.monotonic() < deadline:
            time.sleep(1)
            assert query.exception() is None
    finally:
        query.stop()
    assert ends(room) == {1: ("done", 3, 2)}
