"""Batch tables: create, load, reload, merge, history, retention, compaction, CSV."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.merge import merge_rows
from millrace.session import scratch, stored
from millrace.sources import files

# Columns of the sales table, and its sample rows.
SALES_SCHEMA = (
    "order_id string, customer_id string, product string, category string, "
    "quantity int, unit_price decimal(10,2), order_date date"
)
SAMPLE_SALES = """VALUES
    ('ORD-1001', 'CUST-01', 'wireless-mouse', 'peripherals', 2, 19.99, DATE '2026-01-05'),
    ('ORD-1002', 'CUST-02', 'mechanical-keyboard', 'peripherals', 1, 89.50, DATE '2026-01-05'),
    ('ORD-1003', 'CUST-01', 'usb-c-hub', 'accessories', 3, 34.00, DATE '2026-01-06'),
    ('ORD-1004', 'CUST-03', 'laptop-stand', 'accessories', 1, 45.90, DATE '2026-01-06'),
    ('ORD-1005', 'CUST-02', 'webcam-1080p', 'peripherals', 1, 59.99, DATE '2026-01-07'),
    ('ORD-1006', 'CUST-04', 'noise-cancelling-headset', 'audio', 2, 129.00, DATE '2026-01-07'),
    ('ORD-1007', 'CUST-01', 'noise-cancelling-headset', 'audio', 1, 129.00, DATE '2026-01-08'),
    ('ORD-1008', 'CUST-05', 'wireless-mouse', 'peripherals', 5, 19.99, DATE '2026-01-08'),
    ('ORD-1009', 'CUST-03', 'usb-c-hub', 'accessories', 2, 34.00, DATE '2026-01-09'),
    ('ORD-1010', 'CUST-02', 'mechanical-keyboard', 'peripherals', 1, 89.50, DATE '2026-01-09')
"""

HISTORY_SCHEMA = "snapshot_id bigint, committed_at timestamp, operation string"


def sample_sales(spark: SparkSession) -> DataFrame:
    """The ten literal sales rows."""
    names = ", ".join(part.split()[0] for part in SALES_SCHEMA.split(", "))
    return spark.sql(f"SELECT * FROM ({SAMPLE_SALES}) AS sales({names})").withColumn(
        "unit_price", F.col("unit_price").cast("decimal(10,2)")
    )


def read_spread(spark: SparkSession, path: str, split_bytes: int = 256 << 10, task_bytes: int | None = None) -> DataFrame:
    """Parquet rows for work that is heavy per row, over enough tasks.

    A file that Spark cannot split would keep all but one core idle; its rows are dealt out, at
    least ``split_bytes`` of file per task. With ``task_bytes`` no task gets much more of the file than
    that, however large the table is. A table whose splits spread its rows as well is left alone:
    splits count by the rows in them, as a row group lies in one split and leaves others empty.
    """
    rows = spark.read.parquet(path)
    cores, size = spark.sparkContext.defaultParallelism, files.folder_bytes(spark, path)
    wanted = max(min(cores, size // split_bytes), size // task_bytes if task_bytes else 0)
    if wanted <= 1:
        return rows
    if rows._jdf.queryExecution().toRdd().getNumPartitions() >= wanted:
        # Reads no column, so the files' footers only.
        split = rows.groupBy(F.spark_partition_id().alias("split")).count()
        n, largest = split.agg(F.sum("count"), F.max("count")).first()
        if n is None or largest * wanted <= 2 * n:
            return rows
    return rows.repartition(wanted)


def create_table(spark: SparkSession, name: str, location: str, schema: str = SALES_SCHEMA, by: str = "category") -> None:
    """Create a partitioned Parquet table in the session catalog unless it is there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY ({by}) LOCATION '{location}'")


def write_partitioned(df: DataFrame, path: str, by: str, mode: str) -> None:
    """Write by partition column. The rebalance lets Spark split a hot partition over many tasks
    and keep small ones in one file."""
    writer = df.hint("rebalance", by).write.mode(mode).partitionBy(by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


class LoadedTable:
    """A partitioned table that is reloaded as a whole, with a history of its commits.

    Each reload goes to a folder of its own and becomes visible when its history row is written,
    so readers see the old rows or the new rows and never an empty table. A reload that fails
    leaves no trace readers can see.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str = SALES_SCHEMA, by: str = "category"):
        self.spark, self.schema, self.by = spark, schema, by
        self.data, self.log = f"{path}/data", f"{path}/history"

    def history(self) -> DataFrame:
        """Commits (snapshot_id, committed_at, operation), oldest first."""
        if not files.exists(self.spark, self.log):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        commits = self.spark.read.schema(f"{HISTORY_SCHEMA}, load_id bigint").parquet(self.log)
        return commits.select("snapshot_id", "committed_at", "operation").orderBy("committed_at", "snapshot_id")

    def _last(self) -> tuple[int, int]:
        """The newest snapshot id and load id; zeros for a table without commits."""
        if not files.exists(self.spark, self.log):
            return 0, 0
        commits = self.spark.read.schema(f"{HISTORY_SCHEMA}, load_id bigint").parquet(self.log)
        top = commits.agg(F.max("snapshot_id"), F.max("load_id")).first()
        return top[0] or 0, top[1] or 0

    def _commit(self, operations: list[str], load_id: int) -> None:
        snapshot, _ = self._last()
        now = datetime.now(timezone.utc)
        rows = [
            (snapshot + step, now + timedelta(microseconds=step), operation, load_id)
            for step, operation in enumerate(operations, start=1)
        ]
        self.spark.createDataFrame(rows, f"{HISTORY_SCHEMA}, load_id bigint").coalesce(1).write.mode("append").parquet(self.log)

    def _folder(self, load_id: int) -> str:
        return f"{self.data}/load_id={load_id}"

    def refresh(self, rows: DataFrame) -> None:
        """Replace all rows. Running it again with the same rows changes nothing but the history."""
        _, current = self._last()
        load_id = current + 1
        # An abandoned attempt may have left files under the next id.
        files.drop_partition(self.spark, self.data, "load_id", str(load_id))
        write_partitioned(rows, self._folder(load_id), self.by, "append")
        self._commit(["delete", "append"] if current else ["append"], load_id)

    def append(self, rows: DataFrame) -> None:
        """Add rows without looking: run twice, it leaves every row twice."""
        _, current = self._last()
        load_id = max(current, 1)
        write_partitioned(rows, self._folder(load_id), self.by, "append")
        self._commit(["append"], load_id)

    def read(self) -> DataFrame:
        """The committed rows. A table without commits raises; it is not taken for empty."""
        _, current = self._last()
        if not current:
            raise FileNotFoundError(f"no committed load under {self.data}")
        return self.spark.read.schema(self.schema).parquet(self._folder(current))

    def expire(self) -> int:
        """Drop the folders of superseded loads; returns how many."""
        _, current = self._last()
        old = [value for value in files.partition_values(self.spark, self.data, "load_id") if int(value) < current]
        for value in old:
            files.drop_partition(self.spark, self.data, "load_id", value)
        return len(old)


def merge_into_path(spark: SparkSession, path: str, changes: DataFrame, schema: str, key: str, by: str) -> list[str | None]:
    """Merge ``changes`` into a partitioned table by ``key``, rewriting only touched partitions.

    A partition is touched when it gains a row or holds an old version of one. The new rows are
    staged first and then replace the touched partitions; repeating the merge, also after a
    crash in between, ends with the same rows. Rows without a partition value (NULL, which empty
    text becomes) have a partition of their own. Returns the touched partitions, that one as None.
    """
    staged_changes = scratch(spark, "changes")
    changes.write.parquet(staged_changes)
    changes = spark.read.schema(schema).parquet(staged_changes)
    target = spark.read.schema(schema).parquet(path)
    old_places = target.select(key, by).join(changes.select(key), key, "left_semi").select(by)
    # At most one value per partition folder.
    touched = {row[0] if row[0] != "" else None for row in old_places.union(changes.select(by)).distinct().collect()}
    in_touched = F.col(by).isin([value for value in touched if value is not None])
    in_touched = (in_touched | F.col(by).isNull()) if None in touched else in_touched
    staged = scratch(spark, "merge")
    merged = merge_rows(target.filter(in_touched), changes, key)
    merged.write.parquet(staged)
    result = spark.read.schema(schema).parquet(staged)
    write_partitioned(result, path, by, "overwrite")
    filled = {row[0] if row[0] != "" else None for row in result.select(by).distinct().collect()}
    for value in touched:
        if value not in filled:
            files.drop_partition(spark, path, by, None if value is None else str(value))
    files.drop_folders(spark, staged_changes, staged)
    return sorted(touched, key=lambda value: (value is None, value))


def drop_expired_days(spark: SparkSession, path: str, as_of: str, days: int = 7) -> list[str]:
    """Drop daily partitions that are ``days`` old or older at ``as_of``; returns their names.

    Age counts from the day a partition is named after. A partition without a day in its name, as
    that of lines without a time, has no age and stays. Nothing is rewritten.
    """
    limit = date.fromisoformat(as_of) - timedelta(days=days)
    named = [name for name in files.partition_values(spark, path, "day") if re.fullmatch(r"\d{4}\.\d\d\.\d\d", name)]
    old = [name for name in named if datetime.strptime(name, "%Y.%m.%d").date() <= limit]
    for name in old:
        files.drop_partition(spark, path, "day", name)
    return old


def note_partitions(spark: SparkSession, path: str, registry: str, by: str, as_of: str) -> list[str]:
    """Enter the partitions that ``registry`` does not know yet, as created on the day ``as_of``; returns them.

    Call it after each write. A partition that was entered keeps its day, whatever is added to it
    later, and repeating the call changes nothing. One that was missed, as after a crash, is entered
    by the next call.
    """
    files.make_folder(spark, registry)
    known = set(files.partition_values(spark, registry, by))
    new = [value for value in files.partition_values(spark, path, by) if value not in known]
    if new:
        rows = spark.createDataFrame([(None if value == files.NO_VALUE else value,) for value in new], f"{by} string")
        entered = rows.withColumn("created", F.to_date(F.lit(as_of)))
        entered.write.mode("append").partitionBy(by).parquet(registry)
    return new


def drop_by_creation(spark: SparkSession, path: str, registry: str, by: str, as_of: str, days: int = 7) -> list[str | None]:
    """Drop partitions first written ``days`` ago or earlier at ``as_of``; returns them, that of no value as None.

    Age counts from the first write, so names say nothing: an old day written today stays, and rows
    without a day age like others. A dropped partition is forgotten first and has a new age when it is
    written again; a crash in between leaves it in the table until it is entered and old once more.
    """
    created = spark.read.schema(f"created date, {by} string").parquet(registry)
    first = created.groupBy(by).agg(F.min("created").alias("created"))
    # At most one row per partition folder.
    old = [row[by] for row in first.filter(F.col("created") <= F.date_sub(F.to_date(F.lit(as_of)), days)).collect()]
    for value in old:
        files.drop_partition(spark, registry, by, value)
        files.drop_partition(spark, path, by, value)
    return sorted(old, key=lambda value: (value is None, value))


def compact_partition(spark: SparkSession, path: str, by: str, value: str, file_bytes: int = 256 << 20) -> int:
    """Rewrite one partition into files of about ``file_bytes``; returns the number of files asked for.

    The rows are staged first, so a crash loses nothing.
    """
    folder = files.partition_path(spark, path, by, value)
    wanted = max(1, -(-files.folder_bytes(spark, folder) // file_bytes))
    staged = scratch(spark, "compact")
    rows = spark.read.parquet(folder)
    rows.write.parquet(staged)
    again = spark.read.schema(rows.schema).parquet(staged).withColumn(by, F.lit(value)).repartition(wanted)
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    files.drop_folders(spark, staged)
    return wanted


def file_groups(spark: SparkSession, path: str, by: str, file_bytes: int) -> DataFrame:
    """Files of the partitions that have more than they need, each with its group (by, file, file_group).

    The files of a partition are put in a row and cut after every ``file_bytes``, so a group holds
    about that much. Partitions whose files are as few as their groups are left out.
    """
    rows = spark.read.parquet(path).select(by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    found = rows.distinct()
    before = Window.partitionBy(by).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    group = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / F.lit(file_bytes))
    grouped = found.withColumn("file_group", group)
    whole = Window.partitionBy(by)
    sized = grouped.withColumns({"n_files": F.count("*").over(whole), "n_groups": F.size(F.collect_set("file_group").over(whole))})
    return sized.filter("n_files > n_groups").select(by, "file", "file_group")


def compact_table(spark: SparkSession, path: str, by: str, file_bytes: int = 256 << 20) -> list[str | None]:
    """Pack the small files of all partitions in one job; returns the partitions that were rewritten.

    Rows of a group of files meet in one task and make one file. They are staged first, and then
    replace their partitions, so a crash loses nothing and repeating the work ends the same.
    """
    groups = stored(file_groups(spark, path, by, file_bytes), "file-groups")
    counts = groups.groupBy(by).agg(F.count_distinct("file_group").alias("n")).collect()  # at most one row per partition
    if not counts:
        return []
    touched = [row[by] for row in counts]
    inside = F.col(by).isin([value for value in touched if value is not None])
    inside = (inside | F.col(by).isNull()) if None in touched else inside
    rows = spark.read.parquet(path)
    kept = rows.filter(inside).withColumn("file", F.col("_metadata.file_path")).join(groups.select("file", "file_group"), "file")
    staged = scratch(spark, "compact")
    packed = kept.repartition(sum(row["n"] for row in counts), by, "file_group").drop("file", "file_group")
    packed.select(*rows.columns).write.partitionBy(by).parquet(staged)
    again = spark.read.schema(rows.schema).parquet(staged)
    # One file of the staging folder is one task, unless it is very large.
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    files.drop_folders(spark, staged)
    return sorted(touched, key=lambda value: (value is None, value))


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Write a result as CSV files."""
    df.write.mode("overwrite").option("header", header).csv(path)
