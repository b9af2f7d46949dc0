"""Split the timelines of hot keys, so that no task has to hold a whole key.

A key with more than ``rows_per_piece`` rows is hot. Its timeline is cut into pieces of about
that many rows; what a piece needs from its neighbours travels in a small table with one row
per piece. Both the number of hot keys and the number of cuts are at most the number of rows
divided by ``rows_per_piece``, which is what bounds the two collects below.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_PIECE = 4_000_000
# How many timestamps per piece are looked at to place the cuts. Cuts only balance the work:
# any cuts give the same result.
CUT_SAMPLES = 32


def hot_keys(df: DataFrame, key: str, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Keys with more rows than one piece holds, with their row counts."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_piece)


def micros(ts: Column) -> Column:
    """A timestamp as microseconds, whatever its zone type."""
    return F.unix_micros(ts.cast("timestamp"))


class Timeline:
    """The cuts of every hot key: piece ``i`` holds the times from cut ``i - 1`` up to cut ``i``."""

    def __init__(self, cuts: dict):
        self.cuts = cuts

    @classmethod
    def measure(cls, df: DataFrame, key: str, time: str, hot: DataFrame, rows_per_piece: int) -> Timeline:
        """Place the cuts from a thin look at ``df``, the rows of the hot keys (``time`` in microseconds)."""
        rate = min(1.0, CUT_SAMPLES / rows_per_piece)
        looked_at = df.select(key, time)
        if rate < 1.0:
            looked_at = looked_at.sample(rate, seed=7)
        counts = {row[0]: row["n"] for row in hot.collect()}
        cuts = {}
        for row in looked_at.groupBy(key).agg(F.sort_array(F.collect_list(time)).alias("times")).collect():
            pieces = -(-counts[row[0]] // rows_per_piece)
            times = np.asarray(row["times"], dtype=np.int64)
            at = np.arange(1, pieces) * len(times) // pieces
            cuts[row[0]] = np.unique(times[at])
        return cls(cuts)

    def piece(self, key: Column, time: Column) -> Column:
        """The piece a time falls into."""
        cuts = self.cuts

        @F.pandas_udf("long")
        def locate(keys: pd.Series, times: pd.Series) -> pd.Series:
            values = times.to_numpy(dtype=np.int64)
            pieces = np.zeros(len(keys), dtype=np.int64)
            codes, present = pd.factorize(keys)
            for code, value in enumerate(present):
                if value in cuts:
                    rows = codes == code
                    pieces[rows] = np.searchsorted(cuts[value], values[rows], side="right")
            return pd.Series(pieces)

        return locate(key, time)

    def pieces(self, df: DataFrame, key: str) -> DataFrame:
        """All pieces of all hot keys, one row each: (key, piece)."""
        spark = df.sparkSession
        rows = [(value, len(cut)) for value, cut in self.cuts.items()]
        sizes = spark.createDataFrame(rows, f"`{key}` {df.schema[key].dataType.simpleString()}, last long")
        return sizes.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("piece"))


def carried(per_piece: DataFrame, key: str, value: str, forward: bool, alias: str) -> DataFrame:
    """For each (key, piece), the nearest ``value`` that is not NULL in a piece before it (or after it).

    ``per_piece`` has one row per piece, so its windows stay small however hot a key is.
    """
    order = F.col("piece") if forward else F.col("piece").desc()
    window = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return per_piece.select(key, "piece", F.last(value, ignorenulls=True).over(window).alias(alias))
