"""Aggregates over orders: revenue windows, sales reports, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def revenue_by_window(orders: DataFrame, window: str = "1 minute", watermark: str | None = None) -> DataFrame:
    """Order count and revenue per event-time window and product.

    Only the partial sums of (window, product) are shuffled, so a hot product costs no more
    than one row per map task. On a stream, ``watermark`` bounds the state.
    """
    if watermark is not None:
        orders = orders.withWatermark("event_time", watermark)
    return (
        orders.groupBy(F.window("event_time", window), "product")
        .agg(F.count("*").alias("orders_count"), F.sum("line_total").alias("revenue"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "product",
            "orders_count",
            F.round("revenue", 2).alias("revenue"),
        )
    )


def total_orders(windows: DataFrame) -> DataFrame:
    """One row: the number of orders in a result table, 0 when it is empty."""
    return windows.agg(F.coalesce(F.sum("orders_count"), F.lit(0)).alias("orders"))


def latest_windows(windows: DataFrame, limit: int = 10) -> DataFrame:
    """The most recent windows; ties are broken by product."""
    return windows.orderBy(F.desc("window_start"), "product").limit(limit)


def _spend(lines: DataFrame):
    return F.sum(F.col("quantity") * F.col("unit_price"))


def sales_by_category(lines: DataFrame) -> DataFrame:
    """Revenue and order count per category, highest revenue first."""
    return (
        lines.groupBy("category")
        .agg(_spend(lines).alias("revenue"), F.count("*").alias("order_count"))
        .orderBy(F.desc("revenue"), "category")
    )


def spend_by_customer(lines: DataFrame) -> DataFrame:
    """Total spend of every customer."""
    return lines.groupBy("customer_id").agg(_spend(lines).alias("total_spend"))


def top_customers(lines: DataFrame, limit: int = 3) -> DataFrame:
    """Customers by total spend; ties are broken by customer."""
    return spend_by_customer(lines).orderBy(F.desc("total_spend"), "customer_id").limit(limit)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")


def load_check(df: DataFrame, key: str) -> DataFrame:
    """One row: all rows, distinct keys and the surplus a repeated load has left."""
    per_key = df.groupBy(key).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
    )
