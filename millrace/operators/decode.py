"""Decode JSON order events, judge them, and split them without losing any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import storable_text

ORDER_FIELDS = "order_id string, product string, price double, quantity int, ts string"

# The two reasons a dead letter can carry.
NOT_AN_OBJECT = "not a JSON object matching the schema"
BAD_FIELD = "missing or invalid product, ts, price or quantity"

COORDINATES = ["topic", "kafka_partition", "kafka_offset"]


def event_time(text: Column) -> Column:
    """ISO-8601 text as a timestamp; NULL when it has no date and ``T`` prefix or does not parse."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T"), text.try_cast("timestamp"))


def is_valid_order() -> Column:
    """TRUE or FALSE for every decoded row, never NULL: each comparison is guarded."""
    price, quantity = F.col("price"), F.col("quantity")
    total = price * quantity
    return (
        F.col("product").isNotNull()
        & (F.col("product") != "")
        & F.col("event_time").isNotNull()
        & price.isNotNull()
        & quantity.isNotNull()
        & ~F.isnan(total)
        & (F.abs(total) < float("inf"))
    )


def decode_orders(messages: DataFrame, arrival: str | None = None) -> DataFrame:
    """Messages (topic, partition, offset, value) with their order fields and a verdict.

    ``arrival`` names a column with the time a message arrived, kept as ``arrived_at``.

    The parse sits behind a generator on purpose: the optimizer copies a plain ``from_json``
    into every filter term above it, and would parse each value once per term.
    """
    coordinates = messages.select(
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("value").cast("string").alias("raw_value"),
        *([F.col(arrival).alias("arrived_at")] if arrival else []),
    )
    fields = coordinates.select("*", F.inline_outer(F.array(F.from_json("raw_value", ORDER_FIELDS))))
    return fields.withColumn("event_time", event_time(F.col("ts"))).withColumn("is_valid", is_valid_order())


def valid_orders(decoded: DataFrame) -> DataFrame:
    """Orders to aggregate, with their line total at the full precision of the price."""
    return decoded.filter("is_valid").select(
        "order_id", "product", "price", "quantity", "ts", "event_time",
        (F.col("price") * F.col("quantity")).alias("line_total"),
    )


def dead_letter_reason() -> Column:
    """Why a row failed. A value any field could be read from is an object; otherwise its shape decides."""
    any_field = F.coalesce(*[F.col(name).cast("string") for name in ("order_id", "product", "price", "quantity", "ts")])
    is_object = any_field.isNotNull() | F.json_object_keys("raw_value").isNotNull()
    return F.when(is_object, F.lit(BAD_FIELD)).otherwise(F.lit(NOT_AN_OBJECT))


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Rows that are not valid orders, with delivery coordinates, storable text and a reason."""
    arrival = [name for name in decoded.columns if name == "arrived_at"]
    return decoded.filter("NOT is_valid").select(
        *COORDINATES,
        storable_text(F.col("raw_value")).alias("raw_value"),
        dead_letter_reason().alias("reason"),
        *arrival,
    )


def count_like(df: DataFrame, column: str, like: str, not_like: str | None = None) -> DataFrame:
    """One row ``n``: how many values match ``like`` and do not match ``not_like``."""
    kept = df.filter(F.col(column).like(like))
    if not_like is not None:
        kept = kept.filter(~F.col(column).like(not_like))
    return kept.agg(F.count("*").alias("n"))


def count_equal(df: DataFrame, column: str, value) -> DataFrame:
    """One row ``n``: how many rows hold ``value``."""
    return df.filter(F.col(column) == value).agg(F.count("*").alias("n"))
