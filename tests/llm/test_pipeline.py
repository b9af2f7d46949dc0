"""The pipeline, stage by stage, against what each stage's own input demands."""

import re
from collections import defaultdict

import corpus_pipeline
import pytest
from llm_rows import awkward  # noqa: F401
from test_decontaminate import windows
from test_near_duplicates import brute
from test_packing import check
from test_personal_data import base

from millrace.llm import quality_classifier
from millrace.llm.queries import LLM_QUERIES
from millrace.llm.texts import stored, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for step in steps[1:-1]:
        assert step.columns == steps[0].columns


def test_quality_rejects_what_it_scores_low(spark, steps):
    scored = quality_classifier.judged(steps[0], table(spark, SF, "labels")).collect()
    assert set(texts(steps[1])) == {r["doc_id"] for r in scored if r["predicted"] == 1}


def test_one_document_of_each_group(steps):
    rows = sorted(texts(steps[1]).items())
    wanted = {d for d, n, component, kept in brute(rows, 5) if kept or n == 0}
    assert set(texts(steps[2])) == wanted and len(wanted) < len(rows)


def test_no_benchmark_passage_is_left(spark, steps):
    where, totals = defaultdict(set), {}
    for r in table(spark, SF, "benchmark").collect():
        totals[r["item_id"]] = len(windows(r["text"]))
        for i, w in enumerate(windows(r["text"])):
            where[w].add((r["item_id"], i))

    def holds(text):
        hit = defaultdict(set)
        for w in windows(text or ""):
            for item, i in where.get(w, ()):
                hit[item].add(i)
        return any(len(at) >= 0.8 * totals[item] for item, at in hit.items())

    before = texts(steps[2])
    assert set(texts(steps[3])) == {d for d, t in before.items() if not holds(t)}


def test_personal_data_is_replaced(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert set(before) == set(after)
    for d, text in before.items():
        counts, _ = base(text)
        assert sum(base(after[d])[0]) == 0
        assert (after[d] == text) == (sum(counts) == 0)
        assert not sum(counts) or re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", after[d])
    assert all(r["n_chars"] == len(r["text"]) for r in steps[4].collect())


def test_everything_is_packed(spark, steps):
    check(steps[5].collect(), list(texts(steps[4]).items()))
    whole = LLM_QUERIES["pipeline"](spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(whole) == sorted(steps[5].select("doc_id", "piece", "length", "ids_crc32").collect())


def test_awkward_rows(spark, awkward, tmp_path):
    folder = str(tmp_path)
    awkward.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, 1), (9, 1), (None, 0), (6, None)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
