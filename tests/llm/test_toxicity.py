"""Toxicity: held-out accuracy, smoothing by hand-checked counts, and awkward rows."""

import math
import zlib

import numpy as np
import pytest

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.queries import LLM_QUERIES
from millrace.llm.toxicity import Evidence, Ratios, _key, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scored = {r["doc_id"]: r for r in LLM_QUERIES["op8_toxicity"](spark, SF).collect()}
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for doc_id, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if scored[r["doc_id"]]["held_out"]]
    toxic = [scored[r["doc_id"]]["predicted"] for r in labels if r["toxic"] == 1]
    clean = [scored[r["doc_id"]]["predicted"] for r in labels if r["toxic"] == 0]
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.1


def ratios(toxic, ordinary, discount=1.0):
    rows = [(1, w, n) for w, n in toxic.items()] + [(0, w, n) for w, n in ordinary.items()]
    y, words, n = zip(*rows, strict=True)
    return Ratios(np.array(y), np.array([_key(w) for w in words]), np.array([_key(w[:4]) for w in words]), np.array(n), discount)


def test_discounted_mass_adds_up():
    toxic, ordinary = {"aaaaone": 6, "aaaatwo": 1, "bbbbone": 3}, {"aaaaone": 4, "bbbbone": 5, "cccc": 1}
    r = ratios(toxic, ordinary)
    # Class probabilities of all words sum to one, so expected ratios do: sum of P(w | ordinary) * exp(ratio) = 1.
    words = sorted({*toxic, *ordinary})
    counts = np.array([[c.get(w, 0) for w in words] for c in (ordinary, toxic)], dtype=float)
    taken = np.minimum(counts, 1.0)
    group = np.array([0, 0, 1, 2])
    by_group = np.stack([np.bincount(group, t) for t in taken])
    group_taken = np.minimum(by_group, 1.0)
    mass = np.maximum(by_group - 1, 0) + group_taken.sum(1, keepdims=True) * group_taken.sum(0) / group_taken.sum()
    p = (np.maximum(counts - 1, 0) + mass[:, group] * (taken.sum(0) / by_group.sum(0)[group])) / 10
    assert p.sum(axis=1) == pytest.approx([1, 1])
    for i, w in enumerate(words):
        telling = (counts[:, i] > 1).any()
        expected = math.log(p[1, i] / p[0, i]) if telling else math.log(mass[1, group[i]] / mass[0, group[i]])
        assert r.of(w) == pytest.approx(expected)


def test_rare_words_move_nothing():
    r = ratios({"bad": 50, "rare": 1}, {"good": 50, "odd": 1}, discount=2.0)
    assert r.of("bad") > 2 and r.of("good") < -2
    assert abs(r.of("rare")) < 0.5 and abs(r.of("odd")) < 0.5 and abs(r.of("never")) < 0.5


def test_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame([(7, 1), (9, 0), (9, 0), (None, 1), (1, None), (2, 0)], "doc_id long, toxic int")
    rows = toxicity(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity(no_documents, labels).count() == 0
    assert {r["score"] for r in toxicity(awkward, labels.limit(0)).collect()} == {0.5}


def test_texts_of_mostly_toxic_words_have_evidence():
    evidence = Evidence(ratios({"bad": 50, "worse": 40, "rare": 1}, {"good": 500, "fine": 400, "odd": 1}, discount=2.0))
    nothing = evidence.of("")
    for text in ("bad", "worse", "bad bad worse", "odd bad worse", "good bad worse worse"):
        assert all(a > b + 0.5 for a, b in zip(evidence.of(text), nothing, strict=True)), text
    assert nothing == (0.0, 0.0, 0.0, 0.0)
    for text in ("good", "good fine good"):
        normal, total, above, _ = evidence.of(text)
        assert normal == total == 0 and abs(above) < 0.5


def test_toxic_words_alone_are_found(spark):
    plain = [(i, f"calm words number{i % 7} about weather and trains") for i in range(400)]
    toxic = [(i, f"calm words {('bad', 'worse')[i % 2]} about weather and {('worse', 'bad')[i % 2]} trains") for i in range(400, 500)]
    new = [(1000, "bad"), (1001, "worse bad"), (1002, "Ered. bad worse"), (1003, "weather"), (1004, None)]
    documents = spark.createDataFrame(plain + toxic + new, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 400)) for i in range(500)], "doc_id long, toxic int")
    scored = {r["doc_id"]: r["predicted"] for r in toxicity(documents, labels).collect()}
    assert [scored[i] for i in range(1000, 1005)] == [1, 1, 1, 0, 0]
