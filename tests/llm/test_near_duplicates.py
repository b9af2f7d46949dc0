"""Near duplicates against SQL and brute force, on families whose middle is not a document."""

import random
import re

import numpy as np
import parity
import pytest
from pyspark.sql import functions as F

import millrace.llm.near_duplicates as near_duplicates_module
from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.components import connected_components
from millrace.llm.near_duplicates import _FACTORS, near_duplicates, possibly_in, representatives, shingles, small_keys
from millrace.llm.oracle import LLM_ORACLE
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, width=4):
    """By the contract, all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[top(i)] = min(low.get(top(i), doc_id), doc_id)
    return sorted(((d, len(s), low.get(top(i)), d is not None and low.get(top(i)) == d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_equals_sql(spark):
    name = "op6_near_duplicates"
    assert parity.spark_rows(LLM_QUERIES[name](spark, SF)) == parity.sql_rows(parity.connect(SF), LLM_ORACLE[name])


@pytest.mark.parametrize("seed", [1, 2])
def test_families_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for family in range(12):
        base = rng.choices(vocabulary, k=rng.choice([30, 60, 120]))
        last = base
        for i in range(30):
            # Copies of one middle that is not kept, copies of copies, and shortened ones.
            words = list(rng.choice([base, base, last]))
            for _ in range(rng.randint(0, max(1, len(words) // 22))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if i % 7 == 0:
                words = words[: rng.randint(int(len(words) * 0.75), len(words))]
            if family % 3 == 0:
                words += ["one", "shared", "passage", "that", "many", "documents", "hold", "at", "their", "end"]
            last = words
            texts.append(" ".join(words))
    texts += [" ".join(rng.choices(vocabulary, k=50)) for _ in range(100)] + ["", " ", None, "a b", "A  b", "a b c", "a b c d"]
    rng.shuffle(texts)
    rows = [(i * 3 + 5, t) for i, t in enumerate(texts)]
    assert rows_of(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4)) == brute(rows)


def test_hashes_estimate_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    matches = [np.mean(small_keys(np.sort(pool[:1000])) == small_keys(np.sort(pool[k : 1000 + k]))) for k in (0, 112)]
    assert matches[0] == 1 and 0.2 < matches[1] < 0.8  # 0.8 ** 3 = 0.51
    assert len(set(_FACTORS.tolist())) == len(_FACTORS)
    assert len(shingles(np.arange(1, 4, dtype=np.uint64), 4)) == 1


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 400)] + [(1000, 1001), (1002, 1001), (7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(401), 0), 1000: 1000, 1001: 1000, 1002: 1000}


def test_awkward_rows(spark, awkward, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert rows_of(near_duplicates(awkward, width=4)) == brute(rows)
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "other words are in here"), (2, "other words are in here"), (None, "alone it stands in here")]
    assert rows_of(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4)) == brute(rows)
    assert near_duplicates(no_documents).count() == 0
    kept = representatives(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, None, 5, 6, 7, 8, 9], key=str)
    rows = [r["text"] for r in representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(rows) == ["a b c d e f", "alone it stands in here", "other words are in here"]


def test_filter_before_the_shuffle_loses_no_wanted_row(spark, monkeypatch):
    rows = spark.range(5_000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.xxhash64("id").alias("text_key"))
    wanted = rows.filter("doc_id IS NULL OR doc_id % 10 = 3")
    for marks in (1 << 27, 1 << 15):
        monkeypatch.setattr(near_duplicates_module, "MARKS", marks)
        passed = possibly_in(rows, ["doc_id", "text_key"], wanted)
        assert passed.columns == rows.columns and wanted.exceptAll(passed).isEmpty()
        assert passed.count() <= (520 if marks > 1 << 20 else 1_000)
    assert possibly_in(rows, ["doc_id", "text_key"], wanted.limit(0)).isEmpty()


def test_sets_go_to_their_pivots_in_one_shuffle(spark, monkeypatch):
    rng, plans, counts, stored = random.Random(3), {}, {}, near_duplicates_module.stored

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = stored(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(near_duplicates_module, "stored", recorded)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(3000)], k=60)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i + 1000, texts[i] + " w1") for i in range(20)] + [(i, texts[i]) for i in range(5)] * 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Sets are shuffled by their pivot, and neither by class before that nor when they have been made.
    assert plans["similarities"].count("Exchange hashpartitioning(b#") == 2 and plans["similarities"].count("Exchange") == 3
    assert "MapInArrow" in plans["sets"] and "Exchange" not in plans["sets"].split("MapInArrow")[0]
    # Of some 9,000 small keys only those of rows that share them stay.
    assert counts["class-keys"] <= 40 * 2 * near_duplicates_module.SIDE and counts["sets"] == 40
