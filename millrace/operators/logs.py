"""Opt-in log collection, metadata, filters and phrase search."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import search_text, token_runs, tokens

OPT_IN_LABEL = "co.elastic.logs/enabled"


def label(name: str) -> Column:
    return F.try_element_at("labels", F.lit(name))


def opted_in(containers: DataFrame, label_name: str = OPT_IN_LABEL) -> DataFrame:
    """Containers whose label asks for collection; without the label nothing is collected."""
    return containers.filter(label(label_name) == "true")


def collect_opted_in(lines: DataFrame, containers: DataFrame) -> DataFrame:
    """Lines of the containers that opted in. Spark broadcasts the container list while it is small."""
    return lines.join(opted_in(containers).select("container_id"), "container_id", "left_semi")


def collect_all(lines: DataFrame, containers: DataFrame) -> DataFrame:
    """The failing variant: every line, whatever the labels say. Kept so that the opt-in test can fail."""
    return lines


def attach_metadata(lines: DataFrame, containers: DataFrame) -> DataFrame:
    """Add the name and labels of its container to each line; lines of unknown containers stay."""
    return lines.join(containers, "container_id", "left")


def in_project(project: str, column: str = "container_name") -> Column:
    """Whether a name is that of a numbered instance of a service of ``project``."""
    return F.col(column).rlike(f"^{re.escape(project)}-.+-[0-9]+$")


def label_equals(name: str, value: str) -> Column:
    """Whether a label has a value; a missing label does not."""
    return label(name).eqNullSafe(F.lit(value))


def phrase_count(lines: DataFrame, phrase: str, column: str = "message") -> DataFrame:
    """One row ``n``: texts in which the words of ``phrase`` follow each other, in any case."""
    wanted = search_text(F.lit(phrase))
    return lines.filter(F.contains(search_text(F.col(column)), wanted)).agg(F.count("*").alias("n"))


def phrase_counts(texts: DataFrame, phrases: DataFrame, words: int, column: str = "text") -> DataFrame:
    """Number of texts that hold each phrase of ``phrases`` (phrase), all of ``words`` words.

    Each text offers its own distinct runs of words to an equi-join, so neither texts nor
    phrases are paired with each other. Phrases nobody uses count 0.
    """
    runs = texts.select(F.explode(token_runs(tokens(F.col(column)), words)).alias("phrase"))
    found = runs.join(phrases.distinct(), "phrase", "left_semi").groupBy("phrase").agg(F.count("*").alias("n"))
    return phrases.distinct().join(found, "phrase", "left").select(
        "phrase", F.coalesce("n", F.lit(0)).alias("n")
    )


def log_day(ts: Column) -> Column:
    """Name of the daily partition a line belongs to."""
    return F.date_format(ts, "yyyy.MM.dd")


def expired(day: Column, as_of: str, days: int = 7) -> Column:
    """Whether a daily partition is at least ``days`` old at ``as_of``."""
    return F.to_date(day, "yyyy.MM.dd") <= F.date_sub(F.to_date(F.lit(as_of)), days)
