"""Turn a table into a stream: land it slice by slice in time order and drain a query after each.

Every start but the first resumes from the checkpoint, which is how a restarted job behaves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.messages import land_files
from millrace.streaming.drain import drain

SLICES = 2


def time_slices(df: DataFrame, ts: str = "ts", slices: int = SLICES) -> list[DataFrame]:
    """``df`` cut at equal distances in time; the slices together hold every row once."""
    start, end = df.agg(F.min(ts), F.max(ts)).first()
    if start is None:
        return [df]
    cuts = [start + (end - start) * step / slices for step in range(1, slices)]
    place = F.lit(0)
    for cut in cuts:
        place = place + F.when(F.col(ts) >= F.lit(cut).cast(df.schema[ts].dataType), 1).otherwise(0)
    return [df.filter(place == step) for step in range(slices)]


def replay(slices: list[DataFrame], folder: str, start: Callable[[], StreamingQuery], seconds: int = 3600) -> None:
    """Land each slice in ``folder`` and drain the query that ``start`` starts over it."""
    for rows in slices:
        land_files(rows, folder)
        drain(start(), seconds)
