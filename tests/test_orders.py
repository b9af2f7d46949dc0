"""Decoding, validity, dead letters and revenue, on the awkward values."""

from datetime import datetime, timezone
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import storable_text
from millrace.operators import decode, replay, revenue
from millrace.sources import keyed

GOOD = '{"order_id": "o1", "product": "mouse", "price": 10.0, "quantity": 2, "ts": "2024-01-01T00:00:30+00:00"}'
MESSAGES = "topic string, partition int, offset bigint, value string"


def message_frame(spark, values):
    return spark.createDataFrame([("orders", 0, offset, value) for offset, value in enumerate(values)], MESSAGES)


def verdicts(spark, values):
    rows = decode.decode_orders(message_frame(spark, values)).orderBy("kafka_offset").collect()
    return [row["is_valid"] for row in rows]


def with_field(name, text):
    fields = {"order_id": '"o1"', "product": '"mouse"', "price": "10.0", "quantity": "2", "ts": '"2024-01-01T00:00:30+00:00"'}
    fields[name] = text
    return "{" + ", ".join(f'"{key}": {value}' for key, value in fields.items() if value is not None) + "}"


@pytest.mark.parametrize(
    "value, valid",
    [
        (GOOD, True),
        (with_field("quantity", "-2"), True),
        (with_field("order_id", None), True),
        (with_field("product", "7"), True),
        (with_field("product", '""'), False),
        (with_field("product", None), False),
        (with_field("price", '"1.5"'), False),
        (with_field("price", "NaN"), False),
        (with_field("price", "1e300"), True),
        (with_field("price", "9999999999.0"), True),
        (with_field("price", "4.6566128").replace('"quantity": 2', '"quantity": 2147483647'), True),
        (with_field("price", "1.7e308").replace('"quantity": 2', '"quantity": 2147483647'), False),
        (with_field("price", "Infinity"), False),
        (with_field("quantity", "1.5"), False),
        (with_field("ts", None), False),
        (with_field("ts", '"garbage"'), False),
        (with_field("ts", '"10:00"'), False),
        (with_field("ts", '"2026"'), False),
        (with_field("ts", '"2024-13-01T00:00:00"'), False),
        ("this is not json", False),
        ("[1]", False),
        ('"text"', False),
        ("null", False),
        ("", False),
        (None, False),
    ],
)
def test_validity(spark, value, valid):
    assert verdicts(spark, [value]) == [valid]


def test_nothing_is_lost_in_the_split(spark):
    values = [GOOD, None, "", "x", "[]", with_field("price", "NaN"), with_field("ts", '"garbage"')]
    decoded = decode.decode_orders(message_frame(spark, values))
    assert decoded.filter(F.col("is_valid").isNull()).count() == 0
    assert decode.valid_orders(decoded).count() + decode.dead_letters(decoded).count() == len(values)


def test_plain_cast_would_stop_the_query(spark):
    """Negative control: the unguarded cast raises on the event that try_cast dead-letters."""
    broken = spark.createDataFrame([("garbage",)], "ts string").select(F.col("ts").cast("timestamp"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        broken.collect()


@pytest.mark.parametrize(
    "value, reason",
    [
        ("this is not json", decode.NOT_AN_OBJECT),
        ("[1]", decode.NOT_AN_OBJECT),
        ("5", decode.NOT_AN_OBJECT),
        ("null", decode.NOT_AN_OBJECT),
        ("", decode.NOT_AN_OBJECT),
        (None, decode.NOT_AN_OBJECT),
        ("{}", decode.BAD_FIELD),
        ('{"other": 1}', decode.BAD_FIELD),
        ('{"other": 1, "other": 2}', decode.BAD_FIELD),
        (with_field("price", "NaN"), decode.BAD_FIELD),
        (with_field("product", None), decode.BAD_FIELD),
    ],
)
def test_reason(spark, value, reason):
    dead = decode.dead_letters(decode.decode_orders(message_frame(spark, [value])))
    assert dead.first()["reason"] == reason


def test_dead_letter_text_is_storable(spark):
    texts = spark.createDataFrame([(None,), ("a\x00b",), ("é" * 10_001,)], "t string")
    stored = [row[0] for row in texts.select(storable_text(F.col("t"))).collect()]
    assert stored == ["", "a�b", "é" * 10_001]


def test_long_dead_letter_stays_replayable(spark):
    body = with_field("price", '"x"')[:-1] + ', "note": "' + "y" * 12_000 + '"}'
    dead = decode.dead_letters(decode.decode_orders(message_frame(spark, [body])))
    repair = F.regexp_replace("raw_value", '"price": "x"', '"price": 2.0')
    assert replay.replayable(dead, dead.limit(0), repair).count() == 1


def test_large_and_tiny_orders_keep_their_totals(spark):
    large = with_field("price", "4.6566128").replace('"quantity": 2', '"quantity": 2147483647')
    tiny = with_field("price", "4e-7").replace('"quantity": 2', '"quantity": 1000000000')
    decoded = decode.decode_orders(message_frame(spark, [large, tiny, with_field("price", "1e300")]))
    totals = [row["line_total"] for row in decode.valid_orders(decoded).collect()]
    assert totals == pytest.approx([4.6566128 * 2147483647, 400.0, 2e300])
    windows = revenue.revenue_by_window(decode.valid_orders(decoded)).first()
    assert windows["orders_count"] == 3 and windows["revenue"] == pytest.approx(2e300)


def test_parse_runs_once_per_value(spark):
    """The optimized plan of the valid branch holds a single parse."""
    plan = decode.valid_orders(decode.decode_orders(message_frame(spark, [GOOD])))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    parsed = F.from_json("value", decode.ORDER_FIELDS)
    plain = message_frame(spark, [GOOD]).select(parsed.alias("d")).filter("d.product <> '' AND d.price IS NOT NULL")
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("from_json") > 1


def test_money_is_exact(spark):
    values = [with_field("price", "0.1").replace('"quantity": 2', '"quantity": 1')] * 10
    windows = revenue.revenue_by_window(decode.valid_orders(decode.decode_orders(message_frame(spark, values))))
    assert windows.first()["revenue"] == 1.0
    # Negative control: adding doubles one by one does not give 1.
    assert reduce(add, [0.1] * 10) != 1.0


def test_empty_table_counts_zero(spark):
    windows = revenue.revenue_by_window(decode.valid_orders(decode.decode_orders(message_frame(spark, ["x"]))))
    assert revenue.total_orders(windows).first()["orders"] == 0


def window_row(start, product, count):
    at = datetime(2024, 1, 1, start, tzinfo=timezone.utc)
    return (at, at.replace(minute=1), product, count, float(count))


def windows_frame(spark, rows):
    schema = "window_start timestamp, window_end timestamp, product string, orders_count bigint, revenue double"
    return spark.createDataFrame(rows, schema)


def test_upsert_keeps_the_last_batch_and_replay_changes_nothing(spark, folder):
    path = folder("upsert")
    write = keyed.upsert_writer(path)
    first = windows_frame(spark, [window_row(1, "a", 1), window_row(1, "b", 1)])
    second = windows_frame(spark, [window_row(1, "a", 5)])
    write(first, 0)
    write(second, 1)

    def table():
        return sorted((row["product"], row["orders_count"]) for row in keyed.read_latest(spark, path).collect())

    assert table() == [("a", 5), ("b", 1)]
    write(second, 1)
    write(first, 0)
    assert table() == [("a", 5), ("b", 1)]
    # Negative control: appended rows show the key twice.
    assert first.union(second).groupBy("window_start", "product").count().filter("count > 1").count() == 1


def test_fold_keeps_rows_and_the_newest_batch(spark, folder):
    path = folder("fold")
    write = keyed.upsert_writer(path)
    for batch_id in range(4):
        write(windows_frame(spark, [window_row(1, "a", batch_id), window_row(2, f"p{batch_id}", 1)]), batch_id)
    before = sorted(map(tuple, keyed.read_latest(spark, path).collect()))
    assert keyed.fold_batches(spark, path) == 2
    assert keyed.files.partition_values(spark, path, "batch_id") == ["2", "3"]
    write(windows_frame(spark, [window_row(1, "a", 3), window_row(2, "p3", 1)]), 3)
    assert sorted(map(tuple, keyed.read_latest(spark, path).collect())) == before


def test_insert_keeps_the_first_copy(spark, folder):
    path = folder("insert")
    write = keyed.insert_writer(path)
    dead = decode.dead_letters(decode.decode_orders(message_frame(spark, ["x", "y"])))
    write(dead, 0)
    write(dead.withColumn("reason", F.lit("later")), 1)
    rows = keyed.read_first(spark, path).collect()
    assert len(rows) == 2 and "later" not in {row["reason"] for row in rows}


def test_fold_of_first_copies_keeps_the_first(spark, folder):
    path = folder("fold-first")
    write = keyed.insert_writer(path)
    dead = decode.dead_letters(decode.decode_orders(message_frame(spark, ["x", "y"])))
    for batch_id in range(4):
        write(dead.withColumn("reason", F.lit(f"v{batch_id}")), batch_id)
    assert keyed.fold_first(spark, path) == 2
    assert {row["reason"] for row in keyed.read_first(spark, path).collect()} == {"v0"}


def test_batch_rewritten_as_empty_leaves_nothing(spark, folder):
    path = folder("emptied")
    write = keyed.upsert_writer(path)
    rows = windows_frame(spark, [window_row(1, "a", 1)])
    write(rows, 0)
    write(rows, 1)
    write(rows.limit(0), 1)
    write(rows.limit(0), 0)
    write(windows_frame(spark, [window_row(2, "b", 1)]), 2)
    assert [row["product"] for row in keyed.read_latest(spark, path).collect()] == ["b"]


def test_contract_violation_fails_the_write(spark, folder):
    broken = windows_frame(spark, [window_row(1, None, 1)])
    assert keyed.contract_violations(broken, keyed.REVENUE_SCHEMA).count() == 1
    with pytest.raises(Exception, match="NOT NULL column product"):
        keyed.upsert_writer(folder("contract"))(broken, 0)


def test_missing_table_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        keyed.read_latest(spark, folder("never-written")).count()


def test_replay_takes_repaired_letters_once(spark):
    dead = decode.dead_letters(decode.decode_orders(message_frame(spark, [with_field("price", '"x"'), "junk"])))
    repair = F.regexp_replace("raw_value", '"price": "x"', '"price": 2.0')
    none_yet = dead.limit(0)
    again = replay.replayable(dead, none_yet, repair)
    assert again.columns == ["topic", "partition", "offset", "value"]
    assert verdicts(spark, [row["value"] for row in again.collect()]) == [True]
    assert replay.replayable(dead, dead, repair).count() == 0


HOSTILE = {
    "deep nesting": "[" * 5000,
    "deep object": '{"a":' * 3000 + "1" + "}" * 3000,
    "long number": with_field("price", "1" * 3000),
    "long fraction": with_field("price", "0." + "1" * 3000),
    "quantity overflow": with_field("quantity", "99999999999"),
    "lone surrogate": with_field("product", '"\\ud800"'),
    "bad escape": with_field("product", '"\\x"'),
    "year out of range": with_field("ts", '"9999-12-31T23:59:59.999999+00:00"'),
    "large exponent": with_field("price", "1e999"),
    "long text": with_field("product", '"' + "x" * 300_000 + '"'),
}


@pytest.mark.parametrize("value", HOSTILE.values(), ids=HOSTILE.keys())
def test_hostile_values_do_not_stop_the_query(spark, value):
    decoded = decode.decode_orders(message_frame(spark, [value, GOOD]))
    windows = revenue.revenue_by_window(decode.valid_orders(decoded))
    assert windows.filter("product = 'mouse'").count() >= 1
    assert decode.valid_orders(decoded).count() + decode.dead_letters(decoded).count() == 2
    assert all(row["reason"] for row in decode.dead_letters(decoded).collect())


def test_bytes_that_are_not_text_do_not_stop_the_query(spark):
    rows = [("orders", 0, 0, bytearray(b'\xff\xfe{"a": 1')), ("orders", 0, 1, bytearray(GOOD.encode()))]
    decoded = decode.decode_orders(spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary"))
    assert decode.valid_orders(decoded).count() == 1
    assert decode.dead_letters(decoded).select("reason").count() == 1
    assert decode.dead_letters(decoded).select("raw_value").first()["raw_value"] is not None
