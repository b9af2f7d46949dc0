"""Context mixing: base columns by brute force, the vectorised mixture bit by bit, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm import context_mixing as cm
from millrace.llm.context_mixing import END, ESCAPE, Code, Model, Predictors, mixed_scores
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + [None]


def check_base(rows, out):
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows}
    counts = Counter(w for d, t in rows if not held[d] for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for d, t in rows:
        own = words(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        wanted.append((d, held[d], len(own), sum(counts[w] > 0 for w in own), total, round(base, 5)))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in out]
    for a, b in zip(sorted(got, key=str), sorted(wanted, key=str), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-4)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = LLM_QUERIES["op10_context_mixing"](spark, SF).collect()
    check_base(rows, out)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    held = [r for r in out if r["held_out"] and r["bits_per_byte"] is not None]
    assert np.median([r["bits_per_byte"] for r in held]) < 3.5


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    texts = [[rng.choice([b"a", b"b", b"cc", b"dd"]) for _ in range(rng.randint(0, 400))] for _ in range(30)]
    counts = Counter(w for t in texts for w in t) + Counter({END: 30})
    code = Code(dict(counts))
    tables = np.zeros((cm.ORDERS - 1, 2 * cm.SLOTS), dtype=np.int64)
    bytes_ = np.zeros((cm.ORDERS, 2 * cm.SLOTS), dtype=np.int64)
    for t in texts:
        ids = np.append([code.index[w] for w in t], code.index[END]).astype(np.int64)
        _, slots, bits, _ = cm._steps(code, ids, cm._contexts(ids, np.array([0])))
        cm._add(tables, slots, bits)
    slots, bits, _ = cm._byte_steps([b"a", b"b", b"cc", b"dd"])
    cm._add(bytes_, slots, bits)
    shape = (-1, cm.SLOTS, 2)
    return Model(code, Predictors(tables.reshape(shape)), cm.start_weights(), Predictors(bytes_.reshape(shape)), cm.start_weights(), 1, 1)


def one_by_one(model, ids):
    """The documented model for one document, bit by bit, without numpy's batches."""
    refined = [0.0] * cm.ORDERS
    total = 0.0
    plain, slots, bits, lengths = cm._steps(model.code, np.asarray(ids), cm._contexts(np.asarray(ids), np.array([0])))
    at = 0
    for start in range(0, len(ids), cm.BLOCK):
        moved, seen = [0.0] * cm.ORDERS, 0
        for length in lengths[start : start + cm.BLOCK]:
            for i in range(at, at + length):
                x = [float(plain[i])] + [float(model.token.logits[k][slots[k][i]]) for k in range(cm.ORDERS - 1)]
                gate = sum(int(model.token.gates[k][slots[k][i]]) for k in range(2))
                mixed = sum((float(w) + r) * v for w, r, v in zip(model.gates[gate], refined, x, strict=True))
                p = 1 / (1 + math.exp(-mixed))
                total += math.log(p if bits[i] else 1 - p)
                seen += 1
                moved = [m + (float(bits[i]) - p) * v for m, v in zip(moved, x, strict=True)]
            at += length
        refined = [r + cm.REFINE * m / (seen + 64.0) for r, m in zip(refined, moved, strict=True)]
    return total


def test_documents_side_by_side_equal_one_by_one(model):
    rng = random.Random(8)
    documents = [[rng.randrange(len(model.code.index)) for _ in range(n)] for n in (1, 500, 3, 130, 128, 1, 300)]
    flat = np.concatenate(documents).astype(np.int64)
    begins = np.cumsum([0, *map(len, documents[:-1])])
    assert model.scores(flat, begins) == pytest.approx([one_by_one(model, d) for d in documents], abs=1e-2)


def test_probabilities_add_up(model):
    flat = np.array([[model.code.index[b"a"], s] for s in range(len(model.code.index))]).ravel()
    both = model.scores(flat, np.arange(0, len(flat), 2))
    first = model.scores(np.array([model.code.index[b"a"]]), np.array([0]))[0]
    assert sum(math.exp(b - first) for b in both) == pytest.approx(1, abs=1e-4)
    cache = {}
    model.spelled([bytes([c]) for c in range(256) if c != 32], cache)
    assert sum(math.exp(v) for v in cache.values()) <= 1
    assert ESCAPE in model.code.index


def test_awkward_rows(spark, awkward, no_documents):
    check_base([(r["doc_id"], r["text"]) for r in awkward.collect()], out := mixed_scores(awkward).collect())
    assert {r["bits_per_byte"] for r in out if r["doc_id"] in (1, 2)} == {None}
    assert mixed_scores(no_documents).count() == 0
    only_held_out = spark.createDataFrame([(d, "some words here") for d in range(100) if zlib.crc32(str(d).encode()) % 5 == 1], "doc_id long, text string")
    out = mixed_scores(only_held_out).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in out} == {(0, 0, 0.0)} and all(math.isfinite(r["score"]) for r in out)


def test_weights_are_fitted_on_all_documents_and_words(spark, monkeypatch):
    # 6,000 documents without a word in common: the vocabulary is empty, every word is spelled.
    rows = [(d, f"w{d}") for d in range(6_000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    learned = documents.filter(cm.remainder(documents["doc_id"], cm.DIVISOR) != cm.HELD_OUT)
    fitted, fit = [], cm.gate_weights
    monkeypatch.setattr(cm, "gate_weights", lambda sample, *rest: fitted.append(sample.count()) or fit(sample, *rest))
    model = cm.train(documents, cm.word_counts(learned))
    assert fitted == [learned.count()] and fitted[0] > 4_000
    assert not np.allclose(model.byte_gates, cm.start_weights())


def test_a_cache_that_overflows_changes_nothing(monkeypatch):
    """Words that are held, wanted and new together exceed the cache; each keeps its own probability."""
    monkeypatch.setattr(cm, "SPELLED_CACHE", 10)
    tables = np.random.default_rng(2).integers(0, 9, (cm.ORDERS, cm.SLOTS, 2)).astype(np.float32)
    model = cm.Model(None, None, None, cm.Predictors(tables), cm.start_weights(), 1, 1)
    words = [b"w%d" % n for n in range(40)]
    alone = {w: model.spelled([w], {})[w] for w in words}
    cache: dict = {}
    for start in range(0, 40, 3):
        wanted = words[max(0, start - 8) : start + 3] * 2
        assert model.spelled(wanted, cache) == pytest.approx({w: alone[w] for w in wanted}, rel=1e-5)
