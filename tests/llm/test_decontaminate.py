"""Decontamination against brute force, with changed parameters and inconsistent slots."""

import re
from collections import defaultdict

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.decontaminate import contaminated, without_contaminated
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
ITEM = "A train leaves at 40 km per hour and Anna waits 3 hours before she walks 40 km with Peter to the old station near the river."


def windows(text):
    w = re.sub(r"[^\w\s]+", "", text.lower()).split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def test_query_equals_brute_force(spark):
    where, totals = defaultdict(set), {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        totals[r["item_id"]] = len(windows(r["text"]))
        for i, w in enumerate(windows(r["text"])):
            where[w].add((r["item_id"], i))
    wanted = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        hit = defaultdict(set)
        for w in windows(r["text"] or ""):
            for item, i in where.get(w, ()):
                hit[item].add(i)
        wanted |= {(r["doc_id"], item) for item, at in hit.items() if len(at) >= 0.8 * totals[item]}
    got = LLM_QUERIES["op2_benchmark_decontamination"](spark, SF).collect()
    assert wanted and {(r["doc_id"], r["item_id"]) for r in got} == wanted


def found(spark, texts, item=ITEM):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    return {r["doc_id"]: r for r in contaminated(docs, items).collect()}


def test_other_parameters_are_found_and_mixed_ones_are_not(spark):
    changed = ITEM.replace("40", "75").replace("km", "miles").replace("3", "9").replace("Anna", "Berta").replace("Peter", "Carl")
    mixed = ITEM.replace("40 km per", "12 km per")
    out = found(spark, ["Before. " + ITEM + " After that.", "so " + changed, "so " + mixed, ITEM.upper(), "nothing of the kind is in here at all", ITEM[: len(ITEM) // 2]])
    assert out[0]["verbatim"] and out[0]["coverage"] == 1.0
    assert 1 in out and not out[1]["verbatim"]
    assert 2 not in out and 4 not in out and 5 not in out


def test_awkward_rows(spark, awkward, no_documents):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, "long long long long long"), (4, "long long long long long")], "item_id long, text string")
    rows = [(r["doc_id"], r["item_id"]) for r in contaminated(awkward, items).collect()]
    assert rows == [(7, 4)]
    assert without_contaminated(awkward, items).columns == awkward.columns
    assert without_contaminated(awkward, items).count() == awkward.count() - 1
    assert contaminated(no_documents, items).count() == 0
    assert contaminated(awkward, items.limit(0)).count() == 0


def test_items_rich_in_slots_are_found_as_they_are(spark):
    item = "What is 12 + 34 + 56 + 78 + 90 + 11 + 23?"
    out = found(spark, ["so What is 12 + 34 + 56 + 78 + 90 + 11 + 23? Yes", item, item.replace("56", "57").replace("90", "91"), "What is 1 + 2"], item)
    assert set(out) == {0, 1} and out[1]["verbatim"] and out[1]["coverage"] == 1.0
    names = "Give these: Anna Berta Carl Dora Emil Frieda Gustav"
    assert set(found(spark, ["text. " + names + " and more", "Give these: Anna Carl Berta Emil Dora Gustav Frieda"], names)) == {0}


def test_short_items_are_found_whole(spark):
    assert set(found(spark, ["the tiny Red fox, 3 times", "Tiny red fox", "tiny fox red", "a red fox"], "Tiny red fox")) == {0, 1}
    assert set(found(spark, ["one word here", "none", None], "Word")) == {0}


def test_first_word_may_follow_another(spark):
    for item in ("Compute the area of circles", "Compute the area of circles that touch here"):
        assert set(found(spark, ["then " + item + " again", item, "then " + item.lower(), "nothing like that in here"], item)) == {0, 1, 2}


def test_rows_are_judged_by_their_own_text(spark):
    """Rows that share an id, or have none, keep their own verdict, and halves of a passage do not add up."""
    half = len(ITEM) // 2
    rows = [(None, ITEM), (None, "a clean row without an id"), (None, None), (5, ITEM[:half]), (5, ITEM[half:]), (6, "so " + ITEM), (6, "clean"), (6, "so " + ITEM)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    assert sorted(map(str, (tuple(r) for r in without_contaminated(docs, items).collect()))) == sorted(str(r) for r in rows if r[1] is None or ITEM not in r[1])
    assert sorted(map(str, (r["doc_id"] for r in contaminated(docs, items).collect()))) == ["6", "None"]
