"""Cache status of a request stream.

``ttl_status_stream`` keeps one load time per key in the state store and suits small triggers:
what one key brings into a micro-batch is folded by one task. ``ttl_writer`` keeps the load times
in a table and runs the batch operator on each micro-batch, which cuts hot keys into pieces; it
suits large triggers and backlogs. Both expect micro-batches that follow each other in time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.merge import latest_by_key
from millrace.operators.skew import ROWS_PER_PIECE, micros
from millrace.operators.ttl import CachePolicy, fold_misses, served_status, ttl_status
from millrace.session import stored
from millrace.sources import files
from millrace.sources.keyed import write_batch

SERVED_SCHEMA = "key bigint, time_us bigint, seq bigint, load_us bigint, is_miss boolean"
REQUEST_COLUMNS = ["key", "ts", "seq", "is_read"]


def ttl_status_stream(requests: DataFrame, policy: CachePolicy = CachePolicy()) -> DataFrame:
    """Streaming twin of ``ttl_status``: requests (key bigint, ts, seq bigint, is_read), in time order.

    Rows of a key are ordered within a micro-batch. The trigger's size limit bounds what one key
    can bring into a task.
    """

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["time_us", "seq"])
        last = state.get[0] if state.exists else None
        is_read = rows["is_read"].to_numpy(dtype=bool)
        loads, misses, last = fold_misses(rows["time_us"].to_numpy(), is_read, policy, last)
        if last is not None:
            state.update((last,))
        elif state.exists:
            state.remove()
        served = rows[is_read][["time_us", "seq"]]
        served.insert(0, "key", key[0])
        yield served.assign(load_us=loads[is_read], is_miss=misses[is_read])

    timed = requests.select("key", micros(F.col("ts")).alias("time_us"), "seq", "is_read")
    folded = timed.groupBy("key").applyInPandasWithState(
        fold, SERVED_SCHEMA, "load_us bigint", "append", GroupStateTimeout.NoTimeout
    )
    return folded.select("key", F.timestamp_micros("time_us").alias("ts"), "seq", served_status(policy).alias("status"))


def ttl_writer(
    path: str, policy: CachePolicy = CachePolicy(), rows_per_piece: int = ROWS_PER_PIECE
) -> Callable[[DataFrame, int], None]:
    """A batch callback for ``foreachBatch``: store the status of each read under ``path``/served.

    The load a key is left with goes to ``path``/loads and comes back as that key's first read in
    the next batch it appears in. A replayed batch sees the loads of earlier batches only and
    rewrites its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        requests = stored(batch.select(*REQUEST_COLUMNS), "requests")
        rows = requests.withColumn("carried", F.lit(False))
        before = _open_loads(requests, path, batch_id)
        if before is not None:
            rows = rows.unionByName(before.select("key", "ts", "seq", F.lit(True).alias("is_read"), F.lit(True).alias("carried")))
        served = stored(ttl_status(rows, policy, rows_per_piece), "served")
        answers = served.filter("NOT carried").select("key", "ts", "seq", "status")
        write_batch(answers, f"{path}/served", batch_id)
        write_batch(_loads_after(served, requests, policy), f"{path}/loads", batch_id)

    return write


def _open_loads(requests: DataFrame, path: str, batch_id: int) -> DataFrame | None:
    """Loads (key, ts, seq) that earlier batches left to the keys of this one."""
    spark: SparkSession = requests.sparkSession
    if not files.exists(spark, f"{path}/loads"):
        return None
    kinds = {field.name: field.dataType.simpleString() for field in requests.schema.fields}
    schema = f"key {kinds['key']}, ts {kinds['ts']}, seq {kinds['seq']}, is_open boolean, batch_id bigint"
    earlier = spark.read.schema(schema).parquet(f"{path}/loads").filter(F.col("batch_id") < batch_id)
    wanted = earlier.join(requests.select("key").distinct(), "key", "left_semi")
    return latest_by_key(wanted, ["key"], "batch_id").filter("is_open")


def _loads_after(served: DataFrame, requests: DataFrame, policy: CachePolicy) -> DataFrame:
    """The last load of each key (key, ts, seq) and whether it is still there after its last drop."""
    position = F.struct("ts", "seq")
    loads = served.filter("status = 'miss'").groupBy("key").agg(F.max(position).alias("load"))
    if not policy.cached:
        return loads.select("key", "load.ts", "load.seq", F.lit(True).alias("is_open"))
    drops = requests.filter("NOT is_read").groupBy("key").agg(F.max(position).alias("drop"))
    took_effect = (F.col("drop") > F.col("load")) & (
        micros(F.col("drop.ts")) >= micros(F.col("load.ts")) + policy.load_us
    )
    return loads.join(drops, "key", "left").select(
        "key", "load.ts", "load.seq", (~F.coalesce(took_effect, F.lit(False))).alias("is_open")
    )
