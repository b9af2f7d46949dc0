"""Log lines that a container runtime has written in parts, joined again.

The runtime cuts long lines and marks the last part. Parts are joined within each split of a file
first, so the work on a container is spread over the splits that hold it. A split can begin inside a
line and end inside one: only these edges, at most two lines per container and split, are then
joined across splits in the order of the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

# Parts come from one output of one container, at a place: file, start of the split, number in it.
SOURCE = ["container_id", "stream"]
LINE_SCHEMA = "container_id string, stream string, message string, ts timestamp, parts bigint"


def _ended_before(by: list[str], order: list[str]) -> Column:
    """How many lines ended before a row: equal for the parts of one line."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(F.col("ended").cast("long")).over(before), F.lit(0).cast("long"))


def _glued(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One row per line: its parts in order, the time of the first, and whether the last is there."""
    place = F.struct(*order)
    pieces = F.array_sort(F.collect_list(F.struct(*order, "part")))
    return rows.groupBy(*by).agg(
        F.array_join(F.transform(pieces, lambda p: p["part"]), "").alias("part"),
        F.min_by("ts", place).alias("ts"),
        F.sum("parts").alias("parts"),
        F.max("ended").alias("ended"),
    )


def join_parts(parts: DataFrame) -> DataFrame:
    """Lines of ``parts`` (SOURCE, file, block, nth, part, ts, ended): LINE_SCHEMA and ``ended``.

    ``ended`` is false for a line whose last part is missing. A line without parts (whole) has one.
    A missing part text is empty, and NULL is an output (or container) like any other.
    """
    counted = parts if "parts" in parts.columns else parts.withColumn("parts", F.lit(1).cast("long"))
    counted = counted.withColumns({"part": F.coalesce("part", F.lit("")), "ended": F.coalesce("ended", F.lit(False))})
    split = [*SOURCE, "file", "block"]
    numbered = counted.withColumn("line", _ended_before(split, ["nth"]))
    # Grouped by what the rows are partitioned by already.
    local = stored(_glued(numbered, [*split, "line"], ["nth"]), "lines")
    edge = (F.col("line") == 0) | ~F.col("ended")
    edges = local.filter(edge).withColumn("whole_line", _ended_before(SOURCE, ["file", "block", "line"]))
    joined = _glued(edges, [*SOURCE, "whole_line"], ["file", "block", "line"])
    inner = local.filter(~edge).select(*SOURCE, "part", "ts", "parts", "ended")
    return inner.unionByName(joined.drop("whole_line")).select(
        *SOURCE, F.regexp_replace("part", r"\r?\n$", "").alias("message"), "ts", "parts", "ended"
    )
