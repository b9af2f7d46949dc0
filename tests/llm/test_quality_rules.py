"""Host-level quality rules against SQL, brute force and planted hosts."""

import re
from collections import Counter

import parity

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.oracle import LLM_ORACLE
from millrace.llm.quality_rules import judge_documents
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def repeat_words(words, width=8):
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    counts = Counter(windows)
    return len({p for i, w in enumerate(windows) if counts[w] > 1 for p in range(i, i + width)})


def test_equals_sql(spark):
    name = "op1_host_quality_rules"
    assert parity.spark_rows(LLM_QUERIES[name](spark, SF)) == parity.sql_rows(parity.connect(SF), LLM_ORACLE[name])


def test_repeats_equal_brute_force(spark):
    texts = ["a b c d e f g h " * n + "tail" for n in (1, 2, 3, 40)] + ["a " * k for k in (7, 8, 9, 30)]
    texts += ["x1 x2 x3 x4 x5 x6 x7 x8 mid x1 x2 x3 x4 x5 x6 x7 x8 end x2 x3 x4 x5 x6 x7 x8 mid"]
    rows = judge_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'h' AS source"))
    got = {r["doc_id"]: r["n_repeat_words"] for r in rows.collect()}
    assert got == {i: repeat_words(re.findall(r"[^ \t-\r]+", t)) for i, t in enumerate(texts)}


def test_bad_host_is_rejected_and_small_host_is_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(40))
    bad = " ".join(f"word{i}###" for i in range(40))
    rows = [(i, good, f"h{i % 10}") for i in range(1000)] + [(2000 + i, bad, "spam") for i in range(90)] + [(3000, bad, "tiny"), (3001, good, "spam")]
    out = {r["doc_id"]: r for r in judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not out[2000]["kept"] and not out[3001]["kept"] and out[3001]["host_rejected"]
    assert out[0]["kept"]


def test_awkward_rows(awkward, no_documents):
    rows = [r.asDict() for r in judge_documents(awkward).collect()]
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[3]["n_words"] == 0
    assert by_id[7]["n_repeat_words"] == 30_000 and not by_id[7]["kept"]
    assert by_id[8]["word_chars"] == 200_000
    assert judge_documents(no_documents).count() == 0
