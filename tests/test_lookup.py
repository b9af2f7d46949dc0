"""Lookup keys, loading once per key, failing open."""

import json
import random
import struct
from datetime import datetime

import parity
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from millrace.functions.keys import canonical_json, float_text, lookup_key, product_price
from millrace.operators import lookup
from millrace.plans.catalog import load_counts_of
from millrace.plans.oracle import ORACLE
from millrace.session import stored

TEXTS = ["plain", 'quote " and \\ slash', "tab\tnewline\n\r\b\f", "\x01\x1f\x7f", "é ü 漢字", "😀 pair", "", "a'b/c"]


# Digests that keys of these parameters must have.
LIST_DIGEST = "2cf4a033a0fad102"  # page 1, size 10
NULL_DIGEST = "777fd7cd7406c929"  # a NULL, b true
TEXT_DIGESTS = [
    "7c8d7eeed1a82e3e",
    "c2d33b026db136ec",
    "5aa9860bfaea576e",
    "a2656fad6a4987b5",
    "c983de6b9c98e24e",
    "05fc2d6d9333bd02",
    "639d02715d490962",
    "30160b90c146c5ba",
]  # q each of TEXTS, n its place

# Prices by id.
PRICES = {-20: 50.99, -1: 93.99, 0: 10.99, 1: 17.99, 2: 24.99, 12: 94.99, 13: 11.99, 90: 10.99, 91: 17.99, 199: 53.99}


def test_known_digest(spark):
    rows = spark.sql("SELECT 1 AS id")
    assert rows.select(lookup_key(rows, "shop:", "product", ["id"])).first()[0] == "shop:product:037c9214eef74cc3"


def test_key_ignores_the_order_of_parameters(spark):
    rows = spark.sql("SELECT 1 AS page, 10 AS size")
    one, two = (rows.select(lookup_key(rows, "shop:", "list", names)).first()[0] for names in (["page", "size"], ["size", "page"]))
    assert one == two == f"shop:list:{LIST_DIGEST}"


def test_any_text_gives_the_same_key_as_canonical_json(spark):
    rows = spark.createDataFrame([(text, number) for number, text in enumerate(TEXTS)], "q string, n bigint")
    found = rows.select("q", "n", lookup_key(rows, "p:", "s", ["q", "n"]).alias("key")).collect()
    assert {row["n"]: row["key"] for row in found} == {number: f"p:s:{digest}" for number, digest in enumerate(TEXT_DIGESTS)}


def test_null_and_boolean_parameters(spark):
    rows = spark.sql("SELECT CAST(NULL AS STRING) AS a, true AS b")
    assert rows.select(lookup_key(rows, "", "x", ["a", "b"])).first()[0] == f"x:{NULL_DIGEST}"


def test_other_types_are_refused(spark):
    rows = spark.sql("SELECT CAST(1.5 AS FLOAT) AS x, map(1.5D, 1) AS m")
    for name in "xm":
        with pytest.raises(TypeError):
            lookup_key(rows, "", "x", [name])


FLOATS = [0.0, -0.0, 1.0, -1.5, 0.1, 0.3, 1e15, 1e16, 123456789012345680.0, 0.0001, 0.00001, 1e22, 1e23, 2e-3, 8.41e21, 2.0**60, 5e-324, 1.7976931348623157e308, 1 / 3, 2 / 3, 100.0, 1e100]


def test_floats_are_written_as_python_does(spark):
    rng = random.Random(11)
    numbers = FLOATS + [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)] + [rng.uniform(-1e6, 1e6) for _ in range(2000)] + [round(rng.uniform(0, 1e4), 2) for _ in range(2000)]
    numbers = [x for x in numbers if x == x] + [float("nan"), float("inf"), float("-inf")]
    found = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", float_text(F.col("x")).alias("text")).collect()
    assert [(json.dumps(r["x"]), r["text"]) for r in found if json.dumps(r["x"]) != r["text"]] == []


def test_nested_parameters_are_canonical(spark):
    rows = spark.sql(
        """SELECT named_struct('z', 1.5D, 'a', array(1, NULL), 'e', CAST(NULL AS STRUCT<q: INT>)) AS s,
                  map('é', array(true), 'b', NULL) AS m, map(10, 'x', 9, 'y') AS n, array() AS e,
                  TIMESTAMP_NTZ'2024-01-02 03:04:05.000600' AS t, TIMESTAMP'2024-01-02 03:04:05Z' AS u,
                  array(named_struct('k', DATE'2024-02-29', 'd', 1.50BD)) AS l, CAST(NULL AS ARRAY<INT>) AS g"""
    )
    wanted = {
        "s": {"z": 1.5, "a": [1, None], "e": None}, "m": {"é": [True], "b": None}, "n": {10: "x", 9: "y"}, "e": [],
        "t": "2024-01-02 03:04:05.000600", "u": "2024-01-02 03:04:05+00:00", "l": [{"k": "2024-02-29", "d": "1.50"}], "g": None,
    }
    text = rows.select(canonical_json(rows, list(wanted))).first()[0]
    assert text == json.dumps(wanted, sort_keys=True, separators=(",", ":"))


def test_price_formula(spark):
    rows = spark.range(-20, 200).select("id", product_price(F.col("id")).alias("price")).collect()
    found = {row["id"]: row["price"] for row in rows}
    assert {number: found[number] for number in PRICES} == PRICES


def test_fifty_requests_cost_one_load(spark):
    calls = spark.sparkContext.accumulator(0)

    def load(key):
        calls.add(1)
        return f"value {key}"

    requests = spark.range(50).select(F.lit(1).alias("key"), F.col("id").alias("request"))
    answered = lookup.load_once(requests, lookup.function_loader(load, "string")).collect()
    assert len(answered) == 50 and {row["value"] for row in answered} == {"value 1"}
    assert calls.value == 1
    # Negative control: loading per request asks the source every time.
    lookup.function_loader(load, "string")(requests.select("key")).collect()
    assert calls.value == 51


def test_failing_load_leaves_other_keys_alone(spark):
    def load(key):
        if key == 1:
            raise RuntimeError("database is down")
        return "fine"

    requests = spark.createDataFrame([(1,), (2,), (2,)], "key int")
    rows = lookup.load_once(requests, lookup.function_loader(load, "string")).collect()
    assert sorted((row["key"], row["value"], row["error"]) for row in rows if row["key"] == 2) == [(2, "fine", None)] * 2
    assert [row["error"] for row in rows if row["key"] == 1] == ["database is down"]


@pytest.mark.parametrize("reads", [0, 1, 2])
def test_reads_are_counted_where_they_happen(spark, reads):
    def load(key, read):
        for _ in range(reads):
            read(key)
        return f"v{key}"

    requests = spark.createDataFrame([(1,), (1,), (2,), (None,)], "key long")
    ledger = stored(lookup.counted_loads(requests.distinct().filter("key IS NOT NULL"), load, lambda key: key, "string"), "ledger")
    rows = {r["key"]: (r["loads"], r["answers"], r["one_value"]) for r in lookup.load_counts(requests, ledger).collect()}
    assert rows == {1: (reads, 2, True), 2: (reads, 1, True), None: (0, 1, True)}


def test_callers_that_saw_two_values_are_told(spark):
    """A load per request instead of per key: twice the reads, and answers that differ."""
    def load(key, read):
        return str(random.random()) if read(key) else None

    requests = spark.createDataFrame([(1,), (1,), (2,)], "key long")
    ledger = stored(lookup.counted_loads(requests, load, lambda key: True, "string"), "ledger")
    rows = {r["key"]: (r["loads"], r["one_value"]) for r in lookup.load_counts(requests, ledger).collect()}
    assert rows == {1: (2, False), 2: (1, True)}


def test_a_failing_load_keeps_its_reads(spark):
    def load(key, read):
        read(key)
        raise RuntimeError("too late")

    row = lookup.counted_loads(spark.range(1).select(F.col("id").alias("key")), load, lambda key: key, "string").first()
    assert (row["value"], row["error"], row["reads"]) == (None, "too late", [0])


def test_a_loader_that_reads_twice_is_found_by_the_query(spark):
    wanted = parity.sql_rows(parity.connect(SF_DIR), ORACLE["lookup_load_counts"])

    def twice(key, read):
        return f"product-{read(key)}" if read(key) is not None else None

    assert parity.spark_rows(load_counts_of(spark, SF_DIR, twice)) != wanted


def test_broken_cache_costs_no_answer(spark):
    at = datetime(2024, 1, 1, 12)
    requests = spark.createDataFrame([(1, at), (2, at), (1, datetime(2024, 1, 2, 12)), (1, datetime(2024, 1, 3, 12))], "key int, ts timestamp_ntz")
    cache = spark.createDataFrame(
        [(1, "cached", datetime(2024, 1, 1), datetime(2024, 1, 3))],
        "key int, value string, loaded_at timestamp_ntz, expires_at timestamp_ntz",
    )
    source = spark.createDataFrame([(1, "source"), (2, "source")], "key int, value string")
    served = lookup.fail_open(requests, cache, source, [("2024-01-02 00:00:00", "2024-01-03 00:00:00")])
    rows = [(row["key"], row["value"], row["status"]) for row in served.orderBy("ts", "key").collect()]
    assert rows == [(1, "cached", "hit"), (2, "source", "miss"), (1, "source", "bypass"), (1, "source", "miss")]
    # Negative control: asking the cache alone leaves requests without an answer.
    assert requests.join(cache, "key", "left").filter("value IS NULL").count() == 1
