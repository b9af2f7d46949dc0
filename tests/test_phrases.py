"""The index of word positions against a plain search of the texts."""

import itertools
import random
import re

import pytest

from millrace.operators import phrases

TEXTS = [("a", "to be or not to be"), ("b", "To BE, or? not"), ("c", "be to be"), ("d", ""), ("e", None), ("f", "éa b_c 7 to to to be")]


@pytest.fixture
def index(spark, folder):
    path = folder("index")
    for batch_id, rows in enumerate((TEXTS[:3], TEXTS[3:])):
        for _ in range(2):  # a batch that is written again replaces itself
            phrases.add_to_index(spark.createDataFrame(rows, "id string, message string"), path, batch_id, "id", buckets=4)
    return path


def found(spark, path, phrase):
    return sorted(row["doc"] for row in phrases.search_index(spark, path, phrase, buckets=4).collect())


def plain(phrase, texts=TEXTS):
    words = lambda text: re.findall(r"\w+", (text or "").lower())
    wanted = words(phrase)
    return sorted(doc for doc, text in texts if wanted and any(words(text)[i : i + len(wanted)] == wanted for i in range(len(words(text)))))


def test_search_equals_a_plain_search(spark, index):
    for phrase in ("to be", "be to", "to be or not", "TO to; to be", "not", "éa B_C 7", "to be to be", "or not or", "unknown", "to unknown", "", "?!"):
        assert found(spark, index, phrase) == plain(phrase), phrase


def test_random_texts(spark, folder):
    rng = random.Random(4)
    texts = [(str(i), " ".join(rng.choices("xyz", k=rng.randint(0, 9)))) for i in range(60)]
    path = folder("random")
    phrases.add_to_index(spark.createDataFrame(texts, "id string, message string"), path, 0, "id", buckets=4)
    for phrase in map(" ".join, itertools.product("xy", "xz", "yy")):
        assert found(spark, path, phrase) == plain(phrase, texts), phrase


def test_a_search_reads_the_buckets_of_its_words_only(spark, index):
    plan = phrases.search_index(spark, index, "not to", buckets=4)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "EqualTo(word,not)" in plan and "EqualTo(word,to)" in plan


def test_a_missing_index_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        phrases.search_index(spark, folder("nowhere"), "to be")
