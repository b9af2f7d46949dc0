"""Result tables with a key, written batch by batch.

Each batch owns the folder ``batch_id=N``. Writing a batch again replaces that folder only, so
a replay after a crash changes nothing. Readers combine the batches by key. No row passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import earliest_by_key, latest_by_key
from millrace.session import scratch
from millrace.sources import files

# Columns of the two result tables and their keys.
REVENUE_SCHEMA = (
    "window_start timestamp NOT NULL, window_end timestamp NOT NULL, product string NOT NULL, "
    "orders_count bigint NOT NULL, revenue double NOT NULL"
)
REVENUE_KEY = ["window_start", "product"]
DEAD_LETTER_SCHEMA = (
    "topic string NOT NULL, kafka_partition int NOT NULL, kafka_offset bigint NOT NULL, "
    "raw_value string, reason string NOT NULL, received_at timestamp NOT NULL"
)
DEAD_LETTER_KEY = ["topic", "kafka_partition", "kafka_offset"]


def parse_schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


def contract_violations(df: DataFrame, schema: str) -> DataFrame:
    """Rows that break a NOT NULL of the schema; empty when the contract holds."""
    broken = F.lit(False)
    for field in parse_schema(schema).fields:
        if not field.nullable:
            broken = broken | F.col(field.name).isNull()
    return df.filter(broken)


def enforce_contract(df: DataFrame, schema: str) -> DataFrame:
    """The table's columns in order; a NULL in a NOT NULL column fails the write."""
    columns = []
    for field in parse_schema(schema).fields:
        column = F.col(field.name)
        if not field.nullable:
            message = F.lit(f"NULL in NOT NULL column {field.name}")
            column = F.coalesce(column, F.raise_error(message).cast(field.dataType))
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store one batch under its id, replacing an earlier attempt at the same batch.

    The new rows are written aside and then take the folder's place, so that readers find the one
    or the other. Only a batch that has become empty drops its old folder instead.
    """
    spark = df.sparkSession
    if files.exists(spark, files.partition_path(spark, path, "batch_id", str(batch_id))) and df.isEmpty():
        files.drop_partition(spark, path, "batch_id", str(batch_id))
        return
    _write_folder(df, path, batch_id)


def _write_folder(df: DataFrame, path: str, batch_id: int) -> None:
    """The rebalance keeps a small batch in one file and cuts a large one into files of even size."""
    (
        df.hint("rebalance")
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


# So many batches are folded into one, so many of these again, and so on.
FOLD_EVERY = 10


def upsert_writer(path: str, schema: str = REVENUE_SCHEMA, key: list[str] = REVENUE_KEY, fold_every: int = FOLD_EVERY) -> Callable[[DataFrame, int], None]:
    """A batch callback for ``foreachBatch``: insert or update by key, last write wins.

    Earlier batches, whose commit is certain by now, are folded on the way (``fold_due``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        fold_due(batch.sparkSession, path, batch_id, schema, key, latest_by_key, fold_every)
        write_batch(enforce_contract(batch, schema), path, batch_id)

    return write


def insert_writer(path: str, schema: str = DEAD_LETTER_SCHEMA, key: list[str] = DEAD_LETTER_KEY, fold_every: int = FOLD_EVERY) -> Callable[[DataFrame, int], None]:
    """A batch callback for ``foreachBatch``: insert what is not there yet, stamped with its arrival.

    Earlier batches are folded on the way, as by ``upsert_writer``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        fold_due(batch.sparkSession, path, batch_id, schema, key, earliest_by_key, fold_every)
        stamped = batch.withColumn("received_at", F.current_timestamp())
        write_batch(enforce_contract(stamped, schema), path, batch_id)

    return write


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All stored batches. A table that was never written raises; it is not taken for empty."""
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)


def read_latest(spark: SparkSession, path: str, schema: str = REVENUE_SCHEMA, key: list[str] = REVENUE_KEY) -> DataFrame:
    return latest_by_key(read_batches(spark, path, schema), key, "batch_id")


def read_first(
    spark: SparkSession, path: str, schema: str = DEAD_LETTER_SCHEMA, key: list[str] = DEAD_LETTER_KEY
) -> DataFrame:
    return earliest_by_key(read_batches(spark, path, schema), key, "batch_id")


def fold_batches(
    spark: SparkSession,
    path: str,
    schema: str = REVENUE_SCHEMA,
    key: list[str] = REVENUE_KEY,
    keep: Callable[[DataFrame, list[str], str], DataFrame] = latest_by_key,
) -> int:
    """Combine all batches but the newest into one and drop the superseded ones.

    ``keep`` is how the table's readers pick a row: ``latest_by_key``, or ``earliest_by_key`` where
    the first copy stays.

    The newest batch is left alone because its query may still replay it. A crash at any point
    leaves rows that read the same. Returns the number of folders dropped.
    """
    ids = sorted(int(value) for value in files.partition_values(spark, path, "batch_id"))
    return fold_range(spark, path, ids[0], ids[-1], schema, key, keep) if ids else 0


def fold_range(spark: SparkSession, path: str, first: int, stop: int, schema: str, key: list[str], keep: Callable[[DataFrame, list[str], str], DataFrame]) -> int:
    """Combine the batches from ``first`` to before ``stop`` into the last of them."""
    ids = [i for i in sorted(int(value) for value in files.partition_values(spark, path, "batch_id")) if first <= i < stop]
    if len(ids) < 2:
        return 0
    staged = scratch(spark, "fold")
    stored = read_batches(spark, path, schema).filter(F.col("batch_id").between(ids[0], ids[-1]))
    keep(stored, key, "batch_id").write.parquet(staged)
    _write_folder(spark.read.schema(schema).parquet(staged), path, ids[-1])
    for batch_id in ids[:-1]:
        files.drop_partition(spark, path, "batch_id", str(batch_id))
    files.drop_folders(spark, staged)
    return len(ids) - 1


def fold_due(spark: SparkSession, path: str, batch_id: int, schema: str, key: list[str], keep: Callable[[DataFrame, list[str], str], DataFrame], every: int = FOLD_EVERY) -> int:
    """Fold what is due when batch ``batch_id`` begins: the last ``every`` batches, or a power of it.

    All earlier batches are committed then. A row is rewritten once per power, and the folders left
    are at most ``every`` for each power, however many batches a job has written.
    """
    if batch_id == 0 or batch_id % every or not files.exists(spark, path):
        return 0
    size = every
    while batch_id % (size * every) == 0:
        size *= every
    return fold_range(spark, path, batch_id - size, batch_id, schema, key, keep)


def fold_first(spark: SparkSession, path: str, schema: str = DEAD_LETTER_SCHEMA, key: list[str] = DEAD_LETTER_KEY) -> int:
    """Like fold_batches, for a table whose first copy of a key stays."""
    return fold_batches(spark, path, schema, key, earliest_by_key)


def merge_into_catalog(batch: DataFrame, table: str, key: list[str]) -> None:
    """Upsert into a catalog table whose format has row-level MERGE."""
    spark = batch.sparkSession
    batch.createOrReplaceTempView("incoming_batch")
    condition = " AND ".join(f"t.`{name}` = s.`{name}`" for name in key)
    spark.sql(
        f"MERGE INTO {table} t USING incoming_batch s ON {condition} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
