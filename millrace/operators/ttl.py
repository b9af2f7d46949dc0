"""Which requests a cache with a time to live would serve, and how.

A read is a miss when nothing usable is cached and no load holds the key; the load then blocks
other loads until the value expires. The time to live counts from the load, not from the last
read, so the misses of a key form a chain in which each link depends on the one before.

Most keys are folded in one linear pass over rows sorted by key and time. The timeline of a hot
key is cut into pieces and its chain is found by pointer doubling, in as many rounds as the
logarithm of the chain's length. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.skew import ROWS_PER_PIECE, Timeline, carried, hot_keys, micros
from millrace.session import stored


@dataclass(frozen=True)
class CachePolicy:
    """Timing of a cached lookup.

    ``load`` is how long the source takes, ``lease`` how long a load may hold its key and
    ``wait`` how long a request waits for somebody else's load. A load that outlives its lease
    is not cached.
    """

    ttl: timedelta = timedelta(seconds=30)
    load: timedelta = timedelta(0)
    lease: timedelta = timedelta(seconds=5)
    wait: timedelta = timedelta(seconds=6)

    @property
    def cached(self) -> bool:
        return self.load <= self.lease

    @property
    def load_us(self) -> int:
        return self.load // timedelta(microseconds=1)

    @property
    def hold_us(self) -> int:
        """How long after a miss no other request loads."""
        held = self.load + self.ttl if self.cached else self.lease
        return held // timedelta(microseconds=1)

    @property
    def wait_us(self) -> int:
        return self.wait // timedelta(microseconds=1)


def fold_misses(times: np.ndarray, is_read: np.ndarray, policy: CachePolicy, last: int | None):
    """Fold one key's ordered rows from the load time ``last`` on.

    Returns the load each row sees (-1 for none), a mask of the misses, and the load time to
    carry on with. Work grows with the number of misses, not of rows, apart from array scans.
    """
    size = len(times)
    loads = np.full(size, -1, dtype=np.int64)
    misses = np.zeros(size, dtype=bool)
    reads = np.flatnonzero(is_read)
    drops = np.flatnonzero(~is_read)
    drop_times = times[drops]

    def end_of(load: int, start: int) -> int:
        """First position from ``start`` on at which the value of ``load`` is gone."""
        end = int(np.searchsorted(times, load + policy.hold_us, side="left"))
        if policy.cached and len(drops):
            first = max(
                int(np.searchsorted(drop_times, load + policy.load_us, side="left")),
                int(np.searchsorted(drops, start, side="left")),
            )
            if first < len(drops):
                end = min(end, int(drops[first]))
        return max(end, start)

    position = 0
    if last is not None:
        position = end_of(last, 0)
        loads[:position] = last
        if position < size:
            last = None
    while position < size:
        following = int(np.searchsorted(reads, position, side="left"))
        if following == len(reads):
            last = None
            break
        miss = int(reads[following])
        last = int(times[miss])
        misses[miss] = True
        position = end_of(last, miss + 1)
        loads[miss:position] = last
        if position < size:
            last = None
    return loads, misses, last


def _fold_partition(batches: Iterator[pa.RecordBatch], policy: CachePolicy, key: str) -> Iterator[pa.RecordBatch]:
    """Fold a partition sorted by key and time; only the current key's load time is carried over."""
    open_key, open_load = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        codes = batch.column(key).dictionary_encode()
        keys = codes.dictionary
        key_ids = codes.indices.to_numpy(zero_copy_only=False)
        times = batch.column("time_us").to_numpy(zero_copy_only=False)
        is_read = batch.column("is_read").to_numpy(zero_copy_only=False).astype(bool)
        starts = np.concatenate(([0], np.flatnonzero(np.diff(key_ids)) + 1, [batch.num_rows]))
        loads = np.empty(batch.num_rows, dtype=np.int64)
        misses = np.empty(batch.num_rows, dtype=bool)
        for begin, end in zip(starts[:-1], starts[1:]):
            current = keys[int(key_ids[begin])].as_py()
            carried_load = open_load if current == open_key else None
            found = fold_misses(times[begin:end], is_read[begin:end], policy, carried_load)
            loads[begin:end], misses[begin:end], open_load = found
            open_key = current
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(loads), pa.array(misses)],
            names=[*batch.schema.names, "load_us", "is_miss"],
        )


def served_status(policy: CachePolicy) -> Column:
    """Status of a read from its own time and the time of the load it depends on."""
    since = F.col("time_us") - F.col("load_us")
    status = F.when(F.col("is_miss"), F.lit("miss"))
    if not policy.cached:
        return status.otherwise(F.lit("bypass"))
    left = F.lit(policy.load_us) - since
    return (
        status.when((left > 0) & (left <= policy.wait_us), F.lit("coalesced"))
        .when(left > 0, F.lit("bypass"))
        .otherwise(F.lit("hit"))
    )


def _fold_cold(requests: DataFrame, policy: CachePolicy) -> DataFrame:
    schema = T.StructType([*requests.schema.fields, T.StructField("load_us", T.LongType()), T.StructField("is_miss", T.BooleanType())])
    ordered = requests.repartition("key").sortWithinPartitions("key", "time_us", "seq")
    return ordered.mapInArrow(lambda batches: _fold_partition(batches, policy, "key"), schema)


def _first_at_or_after(probes: DataFrame, targets: DataFrame, timeline: Timeline) -> DataFrame:
    """Probes (key, id, at) with ``found``: the first target (key, at) not before ``at``, or NULL.

    ``at`` is a struct (time_us, seq). Probes and targets of a piece are sorted together; a probe
    without a target in its own piece takes the first one of the next piece that has any.
    """
    piece = timeline.piece(F.col("key"), F.col("at.time_us"))
    goals = targets.select("key", F.lit(None).cast(probes.schema["id"].dataType).alias("id"), "at", F.lit(True).alias("is_goal"))
    asked = probes.select("key", "id", "at", F.lit(False).alias("is_goal"))
    both = goals.unionByName(asked).withColumn("piece", piece)
    # Backwards in time; at equal positions the target comes first and so counts as "at".
    window = (
        Window.partitionBy("key", "piece")
        .orderBy(F.col("at").desc(), F.col("is_goal").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = both.withColumn("near", F.last(F.when(F.col("is_goal"), F.col("at")), ignorenulls=True).over(window))
    first = (
        goals.withColumn("piece", piece).groupBy("key", "piece").agg(F.min("at").alias("first_goal"))
    )
    per_piece = timeline.pieces(probes, "key").join(first, ["key", "piece"], "left")
    later = carried(per_piece, "key", "first_goal", forward=False, alias="far")
    return (
        seen.filter("NOT is_goal")
        .join(later, ["key", "piece"], "left")
        .select("key", "id", F.coalesce("near", "far").alias("found"))
    )


def _chain(reads: DataFrame, following: DataFrame) -> DataFrame:
    """All misses: the first read of each key and whatever ``following`` (key, id, found) leads to.

    Each round doubles the length of every jump and so the known part of every chain.
    """
    members = stored(reads.groupBy("key").agg(F.min("at").alias("at")), "misses")
    jumps = stored(following.filter("found IS NOT NULL").select("key", "id", "found"), "jumps")
    while True:
        reached = stored(_jump(members.select("key", "at"), jumps, "at"), "reached")
        if reached.isEmpty():
            return members
        members = stored(members.unionByName(reached.withColumnRenamed("found", "at").select("key", "at")), "misses")
        twice = _jump(jumps.select("key", "id", F.col("found").alias("at")), jumps, "at")
        jumps = stored(twice, "jumps")


def _jump(rows: DataFrame, jumps: DataFrame, at: str) -> DataFrame:
    """``rows`` whose position leads on, with the position it leads to as ``found`` in place of ``at``."""
    to = jumps.select("key", F.col("id").alias(at), "found")
    return rows.join(to, ["key", at]).drop(at)


def _fold_hot(requests: DataFrame, policy: CachePolicy, timeline: Timeline) -> DataFrame:
    at = F.struct("time_us", "seq")
    first_seq = F.lit(np.iinfo(np.int64).min)
    reads = requests.filter("is_read").select("key", at.alias("at"))
    expiry = F.struct((F.col("id.time_us") + policy.hold_us).alias("time_us"), first_seq.alias("seq"))
    if policy.cached:
        # A drop counts once the value is stored; with instant loads any later drop does.
        stored = at if policy.load_us == 0 else F.struct((F.col("time_us") + policy.load_us).alias("time_us"), first_seq.alias("seq"))
        drops = requests.filter("NOT is_read").select("key", at.alias("at"))
        asked = requests.filter("is_read").select("key", at.alias("id"), stored.alias("at"))
        dropped = _first_at_or_after(asked, drops, timeline)
        gone = F.least(expiry, F.coalesce("found", expiry))
        probes = dropped.select("key", "id", gone.alias("at"))
    else:
        probes = reads.select("key", F.col("at").alias("id")).select("key", "id", expiry.alias("at"))
    following = _first_at_or_after(probes, reads, timeline)
    misses = _chain(reads, following)

    # Mark the misses and let every later row of the piece see the last one.
    rows = requests.select("*", at.alias("at"), F.lit(False).alias("is_mark"))
    blanks = [
        F.lit(None).cast(field.dataType).alias(field.name)
        for field in requests.schema.fields
        if field.name not in ("key", "time_us", "seq")
    ]
    marks = misses.select("key", "at.time_us", "at.seq", *blanks, "at", F.lit(True).alias("is_mark"))
    piece = timeline.piece(F.col("key"), F.col("time_us"))
    window = (
        Window.partitionBy("key", "piece")
        .orderBy("at", F.col("is_mark").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = rows.unionByName(marks).withColumn("piece", piece).withColumn(
        "near", F.last(F.when(F.col("is_mark"), F.col("at")), ignorenulls=True).over(window)
    )
    last = misses.withColumn("piece", timeline.piece(F.col("key"), F.col("at.time_us")))
    per_piece = timeline.pieces(requests, "key").join(
        last.groupBy("key", "piece").agg(F.max("at").alias("last_miss")), ["key", "piece"], "left"
    )
    earlier = carried(per_piece, "key", "last_miss", forward=True, alias="far")
    load = F.coalesce("near", "far")
    return (
        filled.filter("NOT is_mark")
        .join(earlier, ["key", "piece"], "left")
        .select(
            *requests.columns,
            load["time_us"].alias("load_us"),
            (F.col("is_read") & F.coalesce(load == F.col("at"), F.lit(False))).alias("is_miss"),
        )
    )


def ttl_status(
    requests: DataFrame, policy: CachePolicy = CachePolicy(), rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame:
    """Status of every read in ``requests`` (key, ts, seq, is_read); other rows are invalidations.

    ``seq`` (bigint) orders rows of a key with equal times and must be unique among them.
    """
    timed = requests.withColumn("time_us", micros(F.col("ts")))
    hot = stored(hot_keys(timed, "key", rows_per_piece), "hot-keys")
    if hot.isEmpty():
        folded = _fold_cold(timed, policy)
    else:
        names = hot.select("key")
        cold = _fold_cold(timed.join(names, "key", "left_anti").select(*timed.columns), policy)
        # Read several times below, so the source is not scanned again for each.
        warm_rows = stored(timed.join(names, "key", "left_semi").select(*timed.columns), "hot-rows")
        warm = _fold_hot(warm_rows, policy, Timeline.measure(warm_rows, "key", "time_us", hot, rows_per_piece))
        folded = cold.unionByName(warm)
    served = folded.filter("is_read").withColumn("status", served_status(policy))
    return served.select(*requests.columns, "status", F.timestamp_micros("load_us").cast(requests.schema["ts"].dataType).alias("loaded_at"))


def status_counts(served: DataFrame) -> DataFrame:
    """Requests by served status."""
    return served.groupBy("status").agg(F.count("*").alias("requests"))
