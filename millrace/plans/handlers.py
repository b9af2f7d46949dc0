"""The rules of the sample order messages, as a table that Spark evaluates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.operators.routing import Rule, field, is_text

# Fields of a sample message, and the texts of its failures.
ORDER_ID = "order_id"
WISHED_FAILURES = "simulate_failures"
NO_ORDER_ID = "order_id is required"
NO_NUMBER = "invalid literal for int() with base 10: '%s'"
PLANNED_FAILURE = "simulated transient failure %d/%d"


def _wished(body: Column) -> Column:
    return field(body, WISHED_FAILURES, "bigint")


ORDER_RULES = (
    Rule(
        lambda body, attempt: ~is_text(field(body, ORDER_ID)) | (field(body, ORDER_ID, "string") == ""),
        "poison",
        lambda body, attempt: F.lit(NO_ORDER_ID),
    ),
    Rule(
        lambda body, attempt: field(body, WISHED_FAILURES).isNotNull() & _wished(body).isNull(),
        "transient",
        lambda body, attempt: F.format_string(NO_NUMBER, field(body, WISHED_FAILURES, "string")),
    ),
    Rule(
        lambda body, attempt: attempt < _wished(body),
        "transient",
        lambda body, attempt: F.format_string(PLANNED_FAILURE, attempt + 1, _wished(body)),
    ),
)
