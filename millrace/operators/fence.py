"""Writes under a fence: a late writer must not replace a newer value."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import ROWS_PER_PIECE, Timeline, carried, hot_keys, micros
from millrace.session import stored

# Above any bigint, so that (fence, seq) orders like fence * SEQ_RANGE + seq.
SEQ_RANGE = Decimal(10) ** 19


def fenced_values(writes: DataFrame, key: str = "key") -> DataFrame:
    """The value each key ends with: the one written under the highest fence.

    ``writes`` holds (key, fence, seq, value); equal fences are ordered by ``seq``. Neither may
    be negative. The highest write is found per map task first, so a hot key sends one row per
    task; fence and seq ride in one number, which keeps the aggregation on hashes without a sort.
    """
    place = F.col("fence").cast("decimal(19,0)") * SEQ_RANGE + F.col("seq")
    return writes.groupBy(key).agg(
        F.max("fence").alias("fence"), F.max_by("value", place.cast("decimal(38,0)")).alias("value")
    )


def rejected_writes(writes: DataFrame, rows_per_piece: int = ROWS_PER_PIECE, key: str = "key") -> DataFrame:
    """Writes that arrive after one with a higher fence was stored, in order of (ts, seq)."""
    timed = writes.withColumn("time_us", micros(F.col("ts")))
    hot = stored(hot_keys(timed, key, rows_per_piece), "hot-keys")
    if hot.isEmpty():
        judged = timed.withColumn("highest", _highest_before(key))
    else:
        cold = timed.join(hot.select(key), key, "left_anti").withColumn("highest", _highest_before(key))
        warm = stored(timed.join(hot.select(key), key, "left_semi"), "hot-rows")
        timeline = Timeline.measure(warm, key, "time_us", hot, rows_per_piece)
        judged = cold.unionByName(_highest_of_hot(warm, timeline, key))
    return judged.filter(F.col("fence") < F.col("highest")).select(*writes.columns)


def _highest_before(*group: str) -> Column:
    """The highest fence among the rows of the group that arrived earlier."""
    rows = Window.partitionBy(*group).orderBy("time_us", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return F.max("fence").over(rows)


def _highest_of_hot(timed: DataFrame, timeline: Timeline, key: str) -> DataFrame:
    """``timed`` with ``highest``, from windows over single pieces and one row per earlier piece."""
    placed = timed.withColumn("piece", timeline.piece(F.col(key), F.col("time_us")))
    tops = placed.groupBy(key, "piece").agg(F.max("fence").alias("top"))
    upto = Window.partitionBy(key).orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = tops.withColumn("top", F.max("top").over(upto))
    per_piece = timeline.pieces(timed, key).join(running, [key, "piece"], "left")
    earlier = carried(per_piece, key, "top", forward=True, alias="far")
    return (
        placed.withColumn("near", _highest_before(key, "piece"))
        .join(earlier, [key, "piece"], "left")
        .withColumn("highest", F.greatest("near", "far"))
        .select(*timed.columns, "highest")
    )
