"""Text columns: storable text and search tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def storable_text(text: Column) -> Column:
    """Text a row store accepts, whole: NULL becomes empty and NUL becomes U+FFFD."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("\x00"), F.lit("�"))


# Words are runs of letters, marks, digits and underscores.
NOT_WORD = r"[^\p{L}\p{M}\p{N}_]+"


def tokens(text: Column) -> Column:
    """The lower-case words of ``text`` in order; an empty array for text without words.

    This stands in for a search engine's analyzer: it neither stems nor follows the full
    Unicode word-break rules.
    """
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda word: word != "")


def search_text(text: Column) -> Column:
    """The words of ``text`` separated and padded by single spaces."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), F.lit(" "))


def token_runs(words: Column, length: int) -> Column:
    """Every run of ``length`` consecutive words, joined by one space, without repeats."""

    def runs(found: Column) -> Column:
        # Single elements are cheap to reach; a slice would copy the whole array each time.
        positions = F.when(F.size(found) >= length, F.sequence(F.lit(0), F.size(found) - length))
        joined = F.transform(
            positions, lambda start: F.concat_ws(" ", *[F.get(found, start + step) for step in range(length)])
        )
        return F.array_distinct(F.coalesce(joined, F.array().cast("array<string>")))

    # The outer transform binds the words to a variable; written in line, they would be found
    # again for every position.
    return F.element_at(F.transform(F.array(words), runs), 1)
