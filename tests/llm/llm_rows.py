"""Rows that the tests of the text operators share; fixtures, imported by name."""

import pytest

AWKWARD = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", None, None, 4),
    (None, "words of a row without id", "en", "a", 3),
    (5, "same row twice", "en", "b", 14),
    (5, "same row twice", "en", "b", 14),
    (6, "x", None, "b", 1),
    (7, "long " * 30_000, "en", "a", 150_000),
    (8, "y" * 200_000, "en", "a", 200_000),
    (9, "ünïcödé   naïve \x1c text here \U0001f600 done.", "de", "c", 40),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    extra = {c: F.lit(7) for c in ("n_words", "piece", "score", "kept", "spans", "component_id", "key", "m", "host")}
    return spark.createDataFrame(AWKWARD, COLUMNS).withColumns(extra)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)
