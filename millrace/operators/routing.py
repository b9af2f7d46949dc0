"""Message outcomes: done, retry after a delay, or dead letter."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RETRIES = 3
RETRY_DELAY_MS = 3000
LARGEST_COUNT = 2**63 - 1
RETRY_HEADER = "x-retry-count"
ERROR_HEADER = "x-last-error"

Handler = Callable[[dict, int], None]


class InvalidMessage(Exception):
    """Raised by a handler for a message that no retry can fix."""


class Rule(NamedTuple):
    """A handler's rule as columns of the decoded body (variant) and the attempt.

    Where ``broken`` holds the attempt ends with ``status`` (poison or transient) and the error. An
    attempt is ok where no rule of the table is broken; the first broken one decides.
    """

    broken: Callable[[Column, Column], Column]
    status: str
    error: Callable[[Column, Column], Column]


Rules = tuple[Rule, ...]


def field(body: Column, name: str, data_type: str = "variant") -> Column:
    """A field of a decoded body as ``data_type``; NULL where it is absent or cannot be that."""
    return F.try_variant_get(body, f"$.{name}", data_type)


def is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


# How the errors of a body begin.
INVALID_JSON = "invalid JSON: "
NOT_AN_OBJECT = "expected a JSON object, got "

# A flat object of plain strings, whole numbers and literals. Such a body needs no parser to be
# accepted; the quantifiers never give back, so a long body is read once.
_TEXT = r'"[^"\\\x00-\x1f]*+"'
_FIELD = rf"\s*+{_TEXT}\s*+:\s*+(?:{_TEXT}|-?(?:0|[1-9][0-9]*+)|true|false|null)\s*+"
PLAIN_OBJECT = rf"^\s*+\{{(?:{_FIELD}(?:,{_FIELD}){{0,63}}+)?+\}}\s*+$"


class Body(NamedTuple):
    """What a body holds: ``object``, ``other`` or ``invalid``, with the object or the error."""

    kind: str
    value: dict | None
    error: str | None


def read_body(text: str | bytes | None) -> Body:
    """Judge a body by Python's JSON rules; a missing body is an empty one."""
    try:
        value = json.loads("" if text is None else text)
    except (ValueError, RecursionError) as problem:
        return Body("invalid", None, f"{INVALID_JSON}{problem}")
    if type(value) is not dict:
        return Body("other", None, f"{NOT_AN_OBJECT}{type(value).__name__}")
    return Body("object", value, None)


def try_handler(handler: Handler, text, attempt: int) -> tuple[str, str | None]:
    """One attempt as (status, error). No message, however broken, can fail the task."""
    body = read_body(text)
    if body.error is not None:
        return "poison", body.error
    try:
        handler(body.value, attempt)
    except InvalidMessage as problem:
        return "poison", str(problem)
    except Exception as problem:  # a handler may raise anything
        return "transient", str(problem)
    return "ok", None


def decode_kind(body: Column) -> Column:
    """Struct (kind, error, text) of a body: ``object``, ``other`` or ``invalid``, judged strictly.

    Plain objects are recognised by a pattern; only the text of other bodies goes to Python. Of
    these, objects come back as JSON that every parser reads: a repeated key has its last value,
    and constants outside JSON (NaN) are text.
    """

    def judged(text: str | None) -> tuple[str, str | None, str | None]:
        kind, value, error = read_body(text)
        if kind == "object":
            text = json.dumps(json.loads(text, parse_constant=str), ensure_ascii=False)
        return kind, error, text if kind == "object" else None

    @F.pandas_udf("struct<kind string, error string, text string>")
    def judge(texts: pd.Series, plain: pd.Series) -> pd.DataFrame:
        # Most bodies are plain: only the others cost a step of their own.
        kinds, errors, objects = ["object"] * len(texts), [None] * len(texts), [None] * len(texts)
        for place in (~plain.astype(bool)).to_numpy().nonzero()[0]:
            kinds[place], errors[place], objects[place] = judged(texts.iat[place])
        return pd.DataFrame({"kind": kinds, "error": errors, "text": objects})

    # The pattern lets repeated keys pass, which Spark's parser refuses.
    plain = F.coalesce(body.rlike(PLAIN_OBJECT) & F.try_parse_json(body).isNotNull(), F.lit(False))
    # Declared so, the judgement is made once, however often later steps refer to it.
    return judge.asNondeterministic()(F.when(~plain, body), plain)


def with_attempt(messages: DataFrame) -> DataFrame:
    """Add ``attempt`` and ``header_error`` from the untrusted retry header.

    Header values are JSON literals, so a number and the same digits as text stay apart. An
    absent header counts as 0; anything but a non-negative integer is an error and counts as 0. A
    count beyond the integers of a column is the largest of them, which is beyond any limit too.
    """
    literal = F.coalesce(F.col("headers")[RETRY_HEADER], F.lit("0"))
    trusted = literal.rlike(r"^(0|[1-9][0-9]*)$")
    error = F.concat(F.lit(f"invalid {RETRY_HEADER} header: "), literal)
    count = F.coalesce(literal.try_cast("long"), F.lit(LARGEST_COUNT))
    return messages.withColumn(
        "attempt", F.when(trusted, count).otherwise(F.lit(0).cast("long"))
    ).withColumn("header_error", F.when(~trusted, error))


def _attempts(handler: Handler, max_retries: int, single: bool):
    @F.pandas_udf("array<struct<attempt long, status string, error string>>")
    def run(bodies: pd.Series, starts: pd.Series, header_errors: pd.Series) -> pd.Series:
        results = []
        for body, start, header_error in zip(bodies, starts, header_errors):
            start = int(start)
            if header_error is not None:
                results.append([(start, "poison", header_error)])
                continue
            tries = []
            attempt = start
            while True:
                status, error = try_handler(handler, body, attempt)
                tries.append((attempt, status, error))
                if single or status != "transient" or attempt >= max_retries:
                    break
                attempt += 1
            results.append(tries)
        return pd.Series(results)

    # A handler may act on the world: declared so, the optimizer neither repeats nor moves the call.
    once = run.asNondeterministic()
    return once(F.col("body"), F.col("attempt"), F.col("header_error"))


def _step(attempt: Column, status: str, error: Column) -> Column:
    return F.struct(attempt.alias("attempt"), F.lit(status).alias("status"), error.cast("string").alias("error"))


def _made_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column made behind a generator: once a row, not again wherever it is referred to."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _rule_steps(rules: Rules, max_retries: int, single: bool) -> Column:
    """The attempts that a message may need by a table of rules, all in Spark; an error needs none of them."""
    body, start = F.col("parsed_body"), F.col("attempt")

    def step(attempt: Column) -> Column:
        found = _step(attempt, "ok", F.lit(None))
        for rule in reversed(rules):
            broken = F.coalesce(rule.broken(body, attempt), F.lit(False))
            found = F.when(broken, _step(attempt, rule.status, rule.error(body, attempt))).otherwise(found)
        return found

    numbers = F.sequence(start, F.greatest(start, F.lit(max_retries).cast("long")))
    steps = F.array(step(start)) if single else F.transform(numbers, step)
    return F.when(F.col("given_error").isNull(), steps)


def _rule_attempts() -> Column:
    """The attempts of a message, from the columns of ``_tried``: up to the first that no retry follows."""
    steps = F.col("steps")
    ended = F.array_position(steps["status"], "ok"), F.array_position(steps["status"], "poison")
    first = F.least(*[F.when(place > 0, place) for place in ended]).cast("int")
    tries = F.when(first.isNotNull(), F.slice(steps, F.lit(1), first)).otherwise(steps)
    return F.when(F.col("given_error").isNotNull(), F.array(_step(F.col("attempt"), "poison", F.col("given_error")))).otherwise(tries)


def _tried(messages: DataFrame, handler: Handler | Rules, max_retries: int, single: bool) -> DataFrame:
    """Messages with ``tried``, the attempts of each: by a function in Python, or by a table of rules in Spark."""
    started = with_attempt(messages)
    if callable(handler):
        return started.withColumn("tried", _attempts(handler, max_retries, single)).drop("attempt", "header_error")
    decoded = started.withColumn("decoded_body", decode_kind(F.col("body")))
    # Each of these is made once a message, and not again for each rule, attempt and column that reads it.
    parsed = _made_once(decoded, "parsed_body", F.try_parse_json(F.coalesce("decoded_body.text", "body")))
    judged = parsed.withColumn("given_error", F.coalesce("header_error", "decoded_body.error"))
    stepped = _made_once(judged, "steps", _rule_steps(handler, max_retries, single))
    tried = _made_once(stepped, "tried", _rule_attempts())
    return tried.drop("attempt", "header_error", "decoded_body", "parsed_body", "given_error", "steps")


def route_target(status: Column, attempt: Column, max_retries: int = MAX_RETRIES) -> Column:
    """Where a message goes after an attempt: ``done``, ``retry`` or ``dead``."""
    return (
        F.when(status == "ok", F.lit("done"))
        .when((status == "transient") & (attempt < max_retries), F.lit("retry"))
        .otherwise(F.lit("dead"))
    )


def deliver_once(messages: DataFrame, handler: Handler | Rules, max_retries: int = MAX_RETRIES) -> DataFrame:
    """One delivery of each message: its target, next retry count and last error.

    Row by row without a shuffle, so batch and stream input work alike.
    """
    tried = _tried(messages, handler, max_retries, True).withColumn("tried", F.element_at("tried", 1))
    target = route_target(F.col("tried.status"), F.col("tried.attempt"), max_retries)
    return (
        tried.withColumn("target", target)
        .withColumn(
            "retry_count",
            F.when(F.col("target") == "retry", F.col("tried.attempt") + 1).otherwise(F.col("tried.attempt")),
        )
        .withColumn("last_error", F.col("tried.error"))
        .drop("tried")
    )


def attempt_ledger(
    messages: DataFrame,
    handler: Handler | Rules,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Every attempt of every message until it is done or dead, one row each.

    A message yields at most ``max_retries + 1`` rows and never leaves its task.
    """
    tried = _tried(messages, handler, max_retries, False)
    return tried.select("*", F.explode("tried").alias("step")).select(
        *messages.columns,
        "step.attempt",
        "step.status",
        "step.error",
        route_target(F.col("step.status"), F.col("step.attempt"), max_retries).alias("target"),
    )


def final_outcomes(messages: DataFrame, handler: Handler | Rules, max_retries: int = MAX_RETRIES) -> DataFrame:
    """How each message ends: ``done`` or ``dead``, with its attempts, retry count and last error."""
    tried = _tried(messages, handler, max_retries, False)
    last = F.element_at("tried", -1)
    failures = F.filter("tried", lambda step: step["error"].isNotNull())
    return tried.select(
        *messages.columns,
        route_target(last["status"], last["attempt"], max_retries).alias("target"),
        F.size("tried").alias("attempts"),
        last["attempt"].alias("retry_count"),
        F.try_element_at(failures, F.lit(-1))["error"].alias("last_error"),
    )


def attempts_per_message(ledger: DataFrame, key: str = "message_id") -> DataFrame:
    """Attempts and last error of each message in a stored ledger: its last failure, if it had one."""
    failure = F.when(F.col("error").isNotNull(), F.struct("attempt", "error"))
    # A message has few attempts. Their list is built by hash, a maximum of text would be sorted for.
    last = F.try_element_at(F.sort_array(F.collect_list(failure)), F.lit(-1))
    return ledger.groupBy(key).agg(F.count("*").alias("attempts"), last["error"].alias("last_error"))


def queue_depths(routed: DataFrame) -> DataFrame:
    """Messages in the main, retry and dead queue; an empty queue shows 0.

    ``target`` NULL means the message still waits in the main queue.
    """
    def depth(condition: Column) -> Column:
        return F.count_if(condition)

    counts = routed.agg(
        depth(F.col("target").isNull()).alias("main"),
        depth(F.col("target") == "retry").alias("retry"),
        depth(F.col("target") == "dead").alias("dead"),
    )
    rows = [F.struct(F.lit(name).alias("queue"), F.col(name).alias("depth")) for name in ("main", "retry", "dead")]
    return counts.select(F.inline(F.array(*rows)))


def retry_wait_ms(attempt: Column, delay_ms: int = RETRY_DELAY_MS, growth: int = 1) -> Column:
    """Wait before the retry that follows ``attempt``; ``growth`` 2 doubles it each time."""
    if growth == 1:
        return F.lit(delay_ms).cast("long")
    return (F.lit(delay_ms) * F.pow(F.lit(growth), attempt)).cast("long")


def with_due_time(failed: DataFrame, failed_at: str, delay_ms: int = RETRY_DELAY_MS, growth: int = 1) -> DataFrame:
    """Add ``due_at``: when a failed message returns to the main queue."""
    wait = retry_wait_ms(F.col("attempt"), delay_ms, growth)
    return failed.withColumn("due_at", F.timestamp_add("MILLISECOND", wait, F.col(failed_at)))


def due_now(waiting: DataFrame, now: Column) -> DataFrame:
    """Waiting messages whose delay has passed."""
    return waiting.filter(F.col("due_at") <= now)


def conservation(routed: DataFrame) -> DataFrame:
    """One row: received messages against done, dead and waiting ones."""
    return routed.agg(
        F.count("*").alias("received"),
        F.count_if(F.col("target") == "done").alias("done"),
        F.count_if(F.col("target") == "dead").alias("dead"),
        F.count_if(F.col("target") == "retry").alias("waiting"),
    )
