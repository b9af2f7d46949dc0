"""Phrase search from an index of word positions.

The index has a row per word of a text: where it stands (``doc``, ``position``) and the bucket of the
word. It is partitioned by bucket, so a search reads the buckets of its words only, and no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import tokens

INDEX_SCHEMA = "word string, doc string, position int, batch_id bigint, bucket int"
BUCKETS = 64


def bucket_of(word: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def positions(texts: DataFrame, doc: str, column: str = "message", buckets: int = BUCKETS) -> DataFrame:
    """Every word of every text with its place, one row each; NULL and empty texts have none."""
    words = texts.select(F.col(doc).cast("string").alias("doc"), F.posexplode(tokens(F.col(column))).alias("position", "word"))
    return words.select("word", "doc", "position", bucket_of(F.col("word"), buckets).alias("bucket"))


def add_to_index(texts: DataFrame, path: str, batch_id: int, doc: str, column: str = "message", buckets: int = BUCKETS) -> None:
    """Add a batch of new texts; writing a batch again replaces what it wrote before.

    Files are sorted by word, so that a search skips the parts of a file that cannot hold its words.
    """
    found = positions(texts, doc, column, buckets).withColumn("batch_id", F.lit(batch_id).cast("long"))
    spread = found.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word")
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id", "bucket").parquet(path)


def search_index(spark: SparkSession, path: str, phrase: str, buckets: int = BUCKETS) -> DataFrame:
    """One row ``doc`` per text that holds the words of ``phrase`` one after the other, in any case.

    Words are joined in the order of how rare they are, each at its distance from the start of the
    phrase, so what is joined never exceeds the places of the rarest word. A phrase without words, or
    with a word that no text has, is found nowhere. A missing index raises.
    """
    row = spark.range(1).select(tokens(F.lit(phrase)).alias("words")).select("words", F.transform("words", lambda w: bucket_of(w, buckets)).alias("buckets")).first()
    wanted = list(enumerate(zip(row["words"], row["buckets"], strict=True)))
    index = spark.read.schema(INDEX_SCHEMA).parquet(path)
    if not wanted:
        return index.select("doc").limit(0)
    held = index.filter(F.col("bucket").isin(row["buckets"]) & F.col("word").isin(row["words"]))
    # At most one row per word of the phrase.
    times = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    wanted.sort(key=lambda step: times.get(step[1][0], 0))

    def starts(step: int, word: str, bucket: int) -> DataFrame:
        rows = index.filter((F.col("bucket") == bucket) & (F.col("word") == word))
        return rows.select("doc", (F.col("position") - step).alias("start"))

    (first, (word, bucket)), *others = wanted
    places = starts(first, word, bucket)
    for step, (word, bucket) in others:
        places = places.join(starts(step, word, bucket), ["doc", "start"], "left_semi")
    return places.select("doc").distinct()
