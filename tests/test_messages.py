"""Message outcomes: poison, retries, headers, queues."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import routing
from millrace.plans.handlers import ORDER_RULES
from millrace.streaming.retry import outcome_writer

MESSAGES = "message_id bigint, body string, headers map<string,string>"


def queue(spark, *messages):
    return spark.createDataFrame(
        [(number, body, headers) for number, (body, headers) in enumerate(messages)], MESSAGES
    )


def order(failures=0, order_id="o1"):
    return json.dumps({"order_id": order_id, "simulate_failures": failures})


def outcome(spark, body, headers=None, **options):
    return routing.final_outcomes(queue(spark, (body, headers or {})), **{"handler": ORDER_RULES, **options}).first()


@pytest.fixture
def shelf_handler():
    """A handler in Python: shelves 1 to 9, of which the ninth opens at the third attempt."""
    invalid = routing.InvalidMessage

    def open_shelf(message, attempt):
        if not 1 <= message["shelf"] <= 9:
            raise invalid(f"no shelf {message['shelf']}")
        if message["shelf"] == 9 and attempt < 2:
            raise TimeoutError("shelf 9 is stuck")

    return open_shelf


@pytest.mark.parametrize(
    "body, wanted",
    [
        ('{"shelf": 4}', ("done", 1, 0, None)),
        ('{"shelf": 9}', ("done", 3, 2, "shelf 9 is stuck")),
        ('{"shelf": 12}', ("dead", 1, 0, "no shelf 12")),
        ("{}", ("dead", 4, 3, "'shelf'")),
        ("[]", ("dead", 1, 0, "expected a JSON object, got list")),
    ],
)
def test_a_python_function_can_be_the_handler(spark, shelf_handler, body, wanted):
    row = outcome(spark, body, handler=shelf_handler)
    assert (row["target"], row["attempts"], row["retry_count"], row["last_error"]) == wanted


@pytest.mark.parametrize("wish, attempts", [("2", 3), ('"2"', 3), ("1.9", 2), ("true", 2), ("null", 4), ("[]", 4), ("-1", 1), ('"1.5"', 4), ("NaN", 4)])
def test_wishes_are_read_as_whole_numbers(spark, wish, attempts):
    assert outcome(spark, f'{{"order_id": "a", "simulate_failures": {wish}}}')["attempts"] == attempts


def test_last_error_is_found_without_a_sort(spark):
    ledger = routing.attempt_ledger(queue(spark, (order(2), {}), (order(), {})), ORDER_RULES)
    found = routing.attempts_per_message(ledger)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r["message_id"]: (r["attempts"], r["last_error"]) for r in found.collect()} == {0: (3, "simulated transient failure 2/2"), 1: (1, None)}


def test_good_message_is_done(spark):
    row = outcome(spark, order())
    assert (row["target"], row["attempts"], row["last_error"]) == ("done", 1, None)


def test_message_that_recovers_is_not_dead(spark):
    ledger = routing.attempt_ledger(queue(spark, (order(2), {})), ORDER_RULES).orderBy("attempt").collect()
    assert [row["attempt"] for row in ledger] == [0, 1, 2]
    assert [row["target"] for row in ledger] == ["retry", "retry", "done"]


def test_message_is_tried_once_and_retried_max_retries_times(spark):
    def boom(message, attempt):
        raise RuntimeError("boom")

    ledger = routing.attempt_ledger(queue(spark, (order(), {})), boom, 3).orderBy("attempt").collect()
    assert [row["attempt"] for row in ledger] == [0, 1, 2, 3]
    row = outcome(spark, order(), handler=boom)
    assert (row["target"], row["retry_count"], row["last_error"]) == ("dead", 3, "boom")


@pytest.mark.parametrize(
    "body, error",
    [
        ("{this is not json", "invalid JSON"),
        ('{"order_id": "a"} trailing', "invalid JSON"),
        ("", "invalid JSON"),
        (None, "invalid JSON"),
        ("[1]", "expected a JSON object, got list"),
        ('"text"', "expected a JSON object, got str"),
        ("null", "expected a JSON object, got NoneType"),
        ("{}", "order_id is required"),
        ('{"order_id": 7}', "order_id is required"),
        ('{"order_id": ""}', "order_id is required"),
    ],
)
def test_poison_is_dead_after_one_attempt(spark, body, error):
    row = outcome(spark, body)
    assert (row["target"], row["attempts"], row["retry_count"]) == ("dead", 1, 0)
    assert error in row["last_error"]


@pytest.mark.parametrize("body", ['{"order_id": "a", "order_id": "b"}', '{"order_id": "a", "x": NaN}'])
def test_lenient_json_is_accepted(spark, body):
    assert outcome(spark, body)["target"] == "done"


def test_bad_failure_switch_is_transient(spark):
    row = outcome(spark, '{"order_id": "a", "simulate_failures": "abc"}')
    assert (row["target"], row["attempts"]) == ("dead", routing.MAX_RETRIES + 1)


@pytest.mark.parametrize("header", ['"bad"', "-1", "1.5", "true", '"3"', "null", "01"])
def test_bad_retry_header_is_dead_with_count_zero(spark, header):
    row = outcome(spark, order(), {routing.RETRY_HEADER: header})
    assert (row["target"], row["retry_count"]) == ("dead", 0)
    assert routing.RETRY_HEADER in row["last_error"]


def test_bad_header_does_not_stop_the_next_message(spark):
    rows = routing.final_outcomes(queue(spark, (order(), {routing.RETRY_HEADER: '"bad"'}), (order(), {})), ORDER_RULES)
    assert [row["target"] for row in rows.orderBy("message_id").collect()] == ["dead", "done"]
    # Negative control: trusting the header fails the whole job.
    trusting = queue(spark, (order(), {routing.RETRY_HEADER: '"bad"'})).select(F.col("headers")[routing.RETRY_HEADER].cast("int"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        trusting.collect()


def test_retry_count_in_the_header_is_where_attempts_start(spark):
    row = outcome(spark, order(99), {routing.RETRY_HEADER: "2"})
    assert (row["attempts"], row["retry_count"], row["target"]) == (2, 3, "dead")
    beyond = outcome(spark, order(99), {routing.RETRY_HEADER: "8"})
    assert (beyond["attempts"], beyond["retry_count"], beyond["target"]) == (1, 8, "dead")


def test_one_delivery_raises_the_count(spark):
    row = routing.deliver_once(queue(spark, (order(9), {routing.RETRY_HEADER: "1"})), ORDER_RULES).first()
    assert (row["target"], row["retry_count"]) == ("retry", 2)
    assert row["last_error"] == "simulated transient failure 2/9"


def test_empty_queues_show_zero(spark):
    depths = routing.queue_depths(routing.deliver_once(queue(spark, (order(), {})), ORDER_RULES))
    assert {row["queue"]: row["depth"] for row in depths.collect()} == {"main": 0, "retry": 0, "dead": 0}


def test_every_message_is_accounted_for(spark):
    messages = queue(spark, (order(), {}), (order(1), {}), ("x", {}), (order(9), {routing.RETRY_HEADER: "3"}))
    row = routing.conservation(routing.deliver_once(messages, ORDER_RULES)).first()
    assert (row["received"], row["done"], row["dead"], row["waiting"]) == (4, 1, 2, 1)


def test_repeated_batch_is_stored_once(spark, folder):
    path = folder("outcomes")
    write = outcome_writer(path, ORDER_RULES)
    messages = queue(spark, (order(), {}), ("x", {}))
    write(messages, 0)
    write(messages, 0)
    assert spark.read.parquet(path).count() == 2


def test_backoff_doubles(spark):
    failed = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS failed_at, id AS attempt FROM range(3)")
    due = routing.with_due_time(failed, "failed_at", 3000, growth=2).orderBy("attempt").collect()
    assert [row["due_at"].second for row in due] == [3, 6, 12]


def test_count_beyond_the_integers_is_trusted(spark):
    row = outcome(spark, order(9), {routing.RETRY_HEADER: "9" * 30})
    assert (row["target"], row["attempts"], row["retry_count"]) == ("done", 1, 2**63 - 1)


def test_pattern_accepts_only_what_the_parser_accepts(spark):
    bodies = ['{}', ' { "a" : 1 , "b":"x" } ', '{"a": -0}', '{"a": 01}', '{"a": 1,}', '{"a": "\\q"}', '{"a": "tab\there"}', '{"a": 1} x', '{"a": [1]}', '{"é": "ü"}', '{"a": 1\u00a0}', None, ""]
    bodies += ["{" + ", ".join(f'"k{i}": {i}' for i in range(n)) + "}" for n in (64, 65, 5000)] + ['{"a": "' + "x" * 300_000 + '"}']
    rows = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    plain = F.coalesce(F.col("body").rlike(routing.PLAIN_OBJECT), F.lit(False))
    found = rows.select("n", plain.alias("plain"), routing.decode_kind(F.col("body")).alias("d")).collect()
    for row in found:
        wanted = routing.read_body(bodies[row["n"]])
        assert (row["d"]["kind"], row["d"]["error"]) == (wanted.kind, wanted.error)
        assert not row["plain"] or wanted.kind == "object"
    assert sum(row["plain"] for row in found) >= 5


def test_a_rule_is_evaluated_once_for_each_attempt(spark):
    messages = queue(spark, (order(2), {}), (order(9), {}), ("[]", {}))
    for found in (routing.attempt_ledger(messages, ORDER_RULES), routing.final_outcomes(messages, ORDER_RULES), routing.deliver_once(messages, ORDER_RULES)):
        assert found._jdf.queryExecution().executedPlan().toString().count("simulated transient failure") == 1


def test_attempts_end_with_the_first_that_is_not_transient(spark):
    rules = (
        routing.Rule(lambda body, attempt: attempt == routing.field(body, "poisoned", "bigint"), "poison", lambda body, attempt: F.lit("spoilt")),
        routing.Rule(lambda body, attempt: attempt < 2, "transient", lambda body, attempt: F.concat(F.lit("try "), attempt)),
    )
    messages = queue(spark, ('{"poisoned": 1}', {}), ("{}", {}), ('{"poisoned": 0}', {routing.RETRY_HEADER: "7"}), ("[]", {}), ("{}", {routing.RETRY_HEADER: '"x"'}))
    ledger = routing.attempt_ledger(messages, rules).orderBy("message_id", "attempt").collect()
    assert [(r["message_id"], r["attempt"], r["status"], r["error"]) for r in ledger] == [
        (0, 0, "transient", "try 0"), (0, 1, "poison", "spoilt"),
        (1, 0, "transient", "try 0"), (1, 1, "transient", "try 1"), (1, 2, "ok", None),
        (2, 7, "ok", None),
        (3, 0, "poison", "expected a JSON object, got list"),
        (4, 0, "poison", 'invalid x-retry-count header: "x"'),
    ]
