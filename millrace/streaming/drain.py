"""Run a query over everything its source holds, within a time limit."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def drain(query: StreamingQuery, seconds: int = 3600) -> StreamingQuery:
    """Wait for an availableNow query to finish. A failure is raised, and so is running out of time."""
    if not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {seconds} s")
    return query
