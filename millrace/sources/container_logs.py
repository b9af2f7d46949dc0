"""Container log files: a folder per container (named after it, or container_id=name),
one JSON object per line. A line of parts may name its container itself, which goes before its folder.

A folder ``forwarded`` holds what a forwarder has collected from many containers: each line is an object of
the container and its line, so the number of files goes by the bytes and not by the containers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.lines import LINE_SCHEMA, SOURCE, join_parts
from millrace.operators.logs import log_day
from millrace.sources import files
from millrace.sources.keyed import write_batch
from millrace.sources.tables import note_partitions, write_partitioned

# The fields of a container runtime's JSON log line.
LINE_FIELDS = "log string, stream string, time string"
NAMED_FIELDS = f"{LINE_FIELDS}, container_id string"
PART_SCHEMA = "container_id string, stream string, file string, block bigint, nth bigint, part string, ts timestamp, ended boolean, parts bigint"


# The folder of a forwarder, and the fields of its lines.
FORWARDED = "forwarded"
FORWARDED_FIELDS = "container_id string, line string"


def write_forwarded(lines: DataFrame, root: str) -> None:
    """Write lines (container_id, value) as a forwarder does; a container of its own folder has each line as it is."""
    line = F.struct("container_id", F.col("value").alias("line"))
    lines.select(F.to_json(line).alias("value")).hint("rebalance").write.text(f"{root}/{FORWARDED}")


def _lines(text: DataFrame) -> DataFrame:
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]+)/[^/]+$", 1)
    read = text.select(folder.alias("folder"), F.col("value").alias("read"))
    # Lines of other folders are not searched for a forwarder's fields, which may be their own.
    forwarded = F.col("folder") == FORWARDED
    sent = read.select("*", F.inline_outer(F.array(F.from_json(F.when(forwarded, F.col("read")), FORWARDED_FIELDS))))
    rows = sent.select(
        F.when(forwarded, F.col("container_id")).otherwise(F.col("folder")).alias("container_id"),
        F.when(forwarded, F.coalesce("line", F.lit(""))).otherwise(F.col("read")).alias("value"),
    )
    parsed = rows.select("*", F.inline_outer(F.array(F.from_json("value", LINE_FIELDS))))
    # A line that is not in the runtime's format is kept as it is.
    message = F.coalesce(F.regexp_replace("log", r"\r?\n$", ""), "value")
    return parsed.select(
        "container_id",
        message.alias("message"),
        "stream",
        F.col("time").try_cast("timestamp").alias("ts"),
    )


def scan(spark: SparkSession, root: str, pattern: str = "*/*.log") -> DataFrame:
    """Log lines of all containers under ``root``; a missing folder raises."""
    return _lines(spark.read.option("recursiveFileLookup", True).text(f"{root}/{pattern}"))


def stream(
    spark: SparkSession, root: str, files_per_trigger: int | None = None, pattern: str = "*/*.log"
) -> DataFrame:
    """The same lines as a stream that picks up new files and remembers those it has read."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _lines(reader.option("recursiveFileLookup", True).load(f"{root}/{pattern}"))


def _read(text: DataFrame) -> DataFrame:
    """Text lines with where they stand: file and start of the split."""
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def parts_of(read: DataFrame) -> DataFrame:
    """The parts of lines, in the order of their splits; the last part of a line ends in a line break.

    A line that is not in the runtime's format is whole as it is.
    """
    placed = read.withColumn("nth", F.monotonically_increasing_id())
    parsed = placed.select("*", F.inline_outer(F.array(F.from_json("value", NAMED_FIELDS))))
    folder = F.regexp_extract("file", r"([^/=]+)/[^/]+$", 1)
    return parsed.select(
        F.coalesce("container_id", folder).alias("container_id"),
        "stream",
        "file",
        "block",
        "nth",
        F.coalesce("log", "value").alias("part"),
        F.col("time").try_cast("timestamp").alias("ts"),
        F.coalesce(F.col("log").endswith("\n"), F.lit(True)).alias("ended"),
        F.lit(1).cast("long").alias("parts"),
    )


def scan_joined(spark: SparkSession, root: str, pattern: str = "*/*.log") -> DataFrame:
    """Whole log lines of all containers under ``root``: parts are joined across splits and files.

    Files of a container follow each other by name, as rotated ones do. The line that a container is
    still writing is there with ``ended`` false. A missing folder raises.
    """
    return join_parts(parts_of(_read(spark.read.option("recursiveFileLookup", True).text(f"{root}/{pattern}"))))


def stream_parts(spark: SparkSession, root: str, files_per_trigger: int | None = None, pattern: str = "*/*.log") -> DataFrame:
    """The text of new files as a stream, for ``joined_writer``."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _read(reader.option("recursiveFileLookup", True).load(f"{root}/{pattern}"))


def joined_writer(spark: SparkSession, path: str) -> Callable[[DataFrame, int], None]:
    """A batch callback for ``foreachBatch``: store whole lines under ``path``/lines.

    A line that has not ended is carried to the next batch, in ``path``/carry. A repeated batch reads
    the carry that it read before and writes the same lines; the one before that is dropped.
    """
    files.make_folder(spark, f"{path}/carry")

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = parts_of(batch)
        carried = spark.read.schema(f"{PART_SCHEMA}, batch_id bigint").parquet(f"{path}/carry").filter(F.col("batch_id") == batch_id - 1)
        lines = join_parts(parts.unionByName(carried.drop("batch_id").select(*parts.columns)))
        # The carry stands before every file.
        open_lines = lines.filter(~F.col("ended")).select(
            *SOURCE, F.lit("").alias("file"), F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("nth"), F.col("message").alias("part"), "ts", "ended", "parts"
        )
        write_batch(open_lines, f"{path}/carry", batch_id)
        write_batch(lines.filter("ended").drop("ended"), f"{path}/lines", batch_id)
        files.drop_partition(spark, f"{path}/carry", "batch_id", str(batch_id - 2))

    return write


def read_joined(spark: SparkSession, path: str) -> DataFrame:
    """Whole lines that ``joined_writer`` has stored."""
    return spark.read.schema(f"{LINE_SCHEMA}, batch_id bigint").parquet(f"{path}/lines").drop("batch_id")


def write_daily(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Route lines to daily partitions named yyyy.MM.dd after their own time."""
    write_partitioned(lines.withColumn("day", log_day(F.col("ts"))), path, "day", mode)


def ship_daily(lines: DataFrame, path: str, registry: str, as_of: str) -> list[str]:
    """Add lines to their daily partitions on the day ``as_of``; returns the partitions this creates.

    ``tables.drop_by_creation`` counts the age of a partition from that day.
    """
    write_daily(lines, path)
    return note_partitions(lines.sparkSession, path, registry, "day", as_of)
