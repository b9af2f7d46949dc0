"""Bring dead letters back, and watch how many there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.decode import COORDINATES, decode_orders


def replayable(dead: DataFrame, already_replayed: DataFrame, repair: Column) -> DataFrame:
    """Dead letters that ``repair`` makes valid and that were not replayed before.

    The result has the columns of a message log and can be appended to the input.
    """
    repaired = dead.select(
        "topic",
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        repair.alias("value"),
    )
    fixed = decode_orders(repaired).filter("is_valid").select(*COORDINATES, "raw_value")
    fresh = fixed.join(already_replayed.select(*COORDINATES), COORDINATES, "left_anti")
    return fresh.select(
        "topic",
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("raw_value").alias("value"),
    )


def discard(dead: DataFrame, discarded: DataFrame) -> DataFrame:
    """Dead letters without those an operator has discarded."""
    return dead.join(discarded.select(*COORDINATES), COORDINATES, "left_anti")


def depth_alerts(dead: DataFrame, at: str, period: str, limit: int) -> DataFrame:
    """Periods in which more than ``limit`` dead letters arrived."""
    return (
        dead.groupBy(F.date_trunc(period, F.col(at)).alias("period"))
        .agg(F.count("*").alias("dead_letters"))
        .filter(F.col("dead_letters") > limit)
    )


def bypass_alerts(served: DataFrame, at: str, period: str, limit: float) -> DataFrame:
    """Periods in which the share of requests served around the cache exceeds ``limit``."""
    share = F.avg(F.when(F.col("status") == "bypass", 1.0).otherwise(0.0))
    return (
        served.groupBy(F.date_trunc(period, F.col(at)).alias("period"))
        .agg(F.count("*").alias("requests"), share.alias("bypass_rate"))
        .filter(F.col("bypass_rate") > limit)
    )
