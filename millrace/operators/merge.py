"""Keyed merges of tables and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _picked(rows: DataFrame, keys: list[str], version: str, pick) -> DataFrame:
    others = [name for name in rows.columns if name not in (*keys, version)]
    place = F.col(version).cast("decimal(20,0)") * 2**32 + F.pmod(F.xxhash64(*others), F.lit(2**32))
    placed = rows.select(*keys, *others, place.cast("decimal(38,0)").alias("_place"))
    return placed.groupBy(*keys).agg(*[pick(name, "_place").alias(name) for name in others]).select(*keys, *others)


def latest_by_key(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the highest ``version`` of each key, combined before the shuffle.

    One aggregate per column instead of one per row keeps fixed-width columns in Spark's hash
    aggregation. Rows with equal versions are ordered by a hash of the row, so that all columns
    come from the same one.
    """
    return _picked(rows, keys, version, F.max_by)


def earliest_by_key(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the lowest ``version`` of each key: the one stored first stays. Ties as above."""
    return _picked(rows, keys, version, F.min_by)


def merge_rows(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``changes`` in place of those with the same key, and new rows added.

    ``changes`` must hold a key once. Only its keys meet the target in the join.
    """
    kept = target.join(changes.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(changes.select(*target.columns))
