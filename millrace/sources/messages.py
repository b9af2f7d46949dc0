"""Message logs: topic, partition, offset, value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = "topic string, partition int, offset bigint, value string"


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """A topic as a stream. ``earliest`` applies to the first run only; later runs resume from the checkpoint.

    Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select("topic", "partition", "offset", "value")


def file_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, schema: str = MESSAGE_SCHEMA, kind: str = "parquet"
) -> DataFrame:
    """Message files landing in a folder as a stream with the columns of a message log."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def message_stream(spark: SparkSession, source: str, **options) -> DataFrame:
    """A message log from ``kafka`` or ``files``."""
    readers = {"kafka": kafka_stream, "files": file_stream}
    if source not in readers:
        raise ValueError(f"unknown message source {source!r}; use one of {sorted(readers)}")
    return readers[source](spark, **options)


def land_files(messages: DataFrame, path: str, kind: str = "parquet") -> None:
    """Append messages to a landing folder, for streams to pick up."""
    messages.write.mode("append").format(kind).save(path)
