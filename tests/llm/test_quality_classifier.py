"""Quality classifier: held-out accuracy, the linear-time identity against all pairs, awkward rows."""

import itertools
import zlib

import numpy as np
import pytest

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.quality_classifier import Buckets, FactorisationMachine, _values, features, judged, kept
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scored = {r["doc_id"]: r for r in LLM_QUERIES["op4_quality_classifier"](spark, SF).collect()}
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for doc_id, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if scored[r["doc_id"]]["held_out"]]
    assert np.mean([scored[r["doc_id"]]["predicted"] for r in labels if r["quality"] == 1]) >= 0.97
    assert np.mean([scored[r["doc_id"]]["predicted"] for r in labels if r["quality"] == 0]) <= 0.35


def test_linear_time_equals_all_pairs():
    machine = FactorisationMachine(seed=3)
    machine.w[:] = np.random.default_rng(1).normal(0, 0.1, len(machine.w))
    texts = [features(t, None, Buckets()) for t in ("one two three two", "", "UPPER lower 12 ### end.")]
    rows, index = np.cumsum([0, *map(len, texts[:-1])]), np.concatenate(texts)
    got = machine.raw(index, rows)[0]
    for score, own in zip(got, texts, strict=True):
        x = _values(own, np.array([0]))
        wanted = machine.w[own] @ x + sum(machine.v[own[i]] @ machine.v[own[j]] * x[i] * x[j] for i, j in itertools.combinations(range(len(own)), 2))
        assert score == pytest.approx(float(wanted), abs=1e-4)


def test_same_model_every_time(spark):
    a, b = (judged(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))).orderBy("doc_id").limit(50).collect() for _ in range(2))
    assert a == b


def test_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame([(7, 0), (9, 1), (9, 1), (None, 1), (1, None), (2, 0)], "doc_id long, quality int")
    rows = judged(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert judged(no_documents, labels).count() == 0
    assert judged(awkward.drop("n_chars"), labels).count() == len(rows)
    assert all(abs(r["score"] - 0.5) < 0.2 for r in judged(awkward, labels.limit(0)).collect())
    assert kept(awkward, labels).columns == awkward.columns
