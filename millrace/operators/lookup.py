"""Keyed lookups that read the source once per key and survive a broken cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Loader = Callable[[DataFrame], DataFrame]


def table_loader(source: DataFrame, key: str = "key") -> Loader:
    """A loader that reads a keyed table; a key without a row yields NULL."""
    return lambda keys: keys.join(source, key, "left")


def function_loader(function: Callable[[object], object], value_type: str, key: str = "key") -> Loader:
    """A loader that calls ``function`` once for each key, inside the tasks.

    A call that fails yields NULL and its error, and leaves the other keys alone.
    """

    def load(keys: DataFrame) -> DataFrame:
        schema = T.StructType(
            [
                keys.schema[key],
                T.StructField("value", T._parse_datatype_string(value_type)),
                T.StructField("error", T.StringType()),
            ]
        )

        def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                values, errors = [], []
                for one in batch[key]:
                    try:
                        values.append(function(one))
                        errors.append(None)
                    except Exception as error:  # a loader may raise anything
                        values.append(None)
                        errors.append(str(error))
                yield pd.DataFrame({key: batch[key], "value": values, "error": errors})

        return keys.mapInPandas(call, schema)

    return load


def load_once(requests: DataFrame, loader: Loader, key: str = "key") -> DataFrame:
    """Answer every request from one load per distinct key.

    The distinct keys are combined before they are shuffled. Joining the answers back is a
    many-to-one join, in which Spark splits the partition of a hot key.
    """
    return requests.join(loader(requests.select(key).distinct()), key, "left")


Load = Callable[[object, Callable[[object], object]], object]


def counted_loads(keys: DataFrame, load: Load, read: Callable[[object], object], value_type: str, key: str = "key") -> DataFrame:
    """A ledger of what the tasks did for each row of ``keys``: its answer and every read of the source.

    ``load(key, read)`` is the loader; it is handed a ``read`` that counts its calls as they happen, so
    ``reads`` is an array with the key of each. Store the ledger before it is used twice: it is the
    record of one run. A load that fails has a NULL value and its error, and its reads all the same.
    """
    value = T._parse_datatype_string(value_type)
    schema = T.StructType([keys.schema[key], T.StructField("value", value), T.StructField("error", T.StringType()), T.StructField("reads", T.ArrayType(keys.schema[key].dataType))])

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for one in batch[key]:
                reads: list = []

                def counted(asked: object, reads: list = reads) -> object:
                    reads.append(asked)
                    return read(asked)

                try:
                    rows.append((one, load(one, counted), None, reads))
                except Exception as error:  # a loader may raise anything
                    rows.append((one, None, str(error), reads))
            yield pd.DataFrame(rows, columns=[key, "value", "error", "reads"])

    return keys.select(key).mapInPandas(call, schema)


def load_counts(requests: DataFrame, ledger: DataFrame, key: str = "key") -> DataFrame:
    """Per requested key: reads of the source, and whether all its callers were answered with one value.

    Reads are counted from the ledger, for the key that was read, whoever asked for it; answers are
    what each request gets by joining the ledger back. NULL is a key like any other.
    """
    reads = ledger.select(F.explode("reads").alias("read_key")).groupBy("read_key").agg(F.count("*").alias("reads"))
    answers = ledger.select(F.col(key).alias("answered_key"), "value")
    served = requests.select(key).join(answers, F.col(key).eqNullSafe(F.col("answered_key")), "left")
    seen = served.groupBy(key).agg(
        F.count("*").alias("answers"),
        F.count_distinct("value").alias("values"),
        F.count("value").alias("known"),
    )
    one_value = (F.col("values") <= 1) & ((F.col("known") == 0) | (F.col("known") == F.col("answers")))
    return seen.join(reads, F.col(key).eqNullSafe(F.col("read_key")), "left").select(
        key, F.coalesce("reads", F.lit(0)).alias("loads"), "answers", one_value.alias("one_value")
    )


def _within(at: Column, intervals: list[tuple[str, str]]) -> Column:
    inside = F.lit(False)
    for start, end in intervals:
        inside = inside | ((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))
    return inside


def fail_open(
    requests: DataFrame,
    cache: DataFrame,
    source: DataFrame,
    outages: list[tuple[str, str]],
    key: str = "key",
) -> DataFrame:
    """Serve each request from the cache when that is possible and from the source otherwise.

    ``cache`` holds (key, value, loaded_at, expires_at), at most one row per key. During an
    outage the cache is not asked at all and the status is ``bypass``. The two keyed tables are
    joined first, so the requests meet one table in one join, in which Spark can split a hot key.
    """
    kept = cache.select(key, F.col("value").alias("cached_value"), "loaded_at", "expires_at")
    read = source.select(key, F.col("value").alias("source_value"))
    fresh = (
        F.col("loaded_at").isNotNull() & (F.col("ts") >= F.col("loaded_at")) & (F.col("ts") < F.col("expires_at"))
    )
    status = F.when(_within(F.col("ts"), outages), "bypass").when(fresh, "hit").otherwise("miss")
    return (
        requests.join(kept.join(read, key, "full_outer"), key, "left")
        .withColumn("status", status)
        .withColumn("value", F.when(F.col("status") == "hit", F.col("cached_value")).otherwise(F.col("source_value")))
        .select(*requests.columns, "value", "status")
    )
