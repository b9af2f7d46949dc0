"""Packing: exact round trip of the ids, gapless sequences, and optimal or near-optimal plans."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.packing import best_fit, packed, plan, reduced
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def ids_of(texts):
    tokenizer = Tokenizer.from_file(FILES[0])
    return [[*e.ids, 2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check(rows, texts):
    """Rows against what the contract says about pieces and places; returns the number of sequences."""
    by_doc, places = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for (doc_id, _), ids in zip(texts, ids_of([t or "" for _, t in texts]), strict=True):
        at = 0
        for i, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at)
            assert i == 0 or r["length"] == 1024
            own = np.asarray(ids[at : at + r["length"]], dtype="<u4")
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
            at += r["length"]
        assert at == len(ids) and len(by_doc[doc_id]) == -(-at // 1024)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places)


def test_query_round_trip(spark):
    rows = LLM_QUERIES["op3_best_fit_packing"](spark, SF).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n = check(rows, texts)
    assert n <= 1.01 * sum(r["length"] for r in rows) / 1024 + 2


def test_white_space_and_special_tokens(spark):
    texts = list(enumerate(["a  b", "a \n b", "x\n\n y", " lead", "trail ", " ", "", None, "a  b  c", "it's 's  '", "<|endoftext|> in text", "tab\t here", "1,2 3.5 \U0001f600 é"]))
    check(packed(spark.createDataFrame(texts, "doc_id long, text string"), *FILES).collect(), texts)


def fewest(items, capacity):
    """Fewest bins, by trying every placement."""
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 16, 25])
    items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 10))), reverse=True)
    fixed, left = reduced(dict(Counter(items)), capacity)
    rest = sorted(itertools.chain.from_iterable([length] * n for length, n in left.items()), reverse=True)
    assert sum(n for _, n in fixed) + fewest(rest, capacity) == fewest(items, capacity)
    patterns = plan(dict(Counter(items)), capacity)
    used = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= capacity
        used.update({length: k * n for length, k in Counter(pattern).items()})
    assert used == Counter(items)


def test_best_fit_equals_one_by_one():
    rng = random.Random(5)
    for _ in range(30):
        items = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
        rooms = []
        for item in items:
            fitting = [r for r in rooms if r >= item]
            room = min(fitting) if fitting else 100
            if fitting:
                rooms.remove(room)
            rooms.append(room - item)
        assert sum(n for _, n in best_fit(dict(Counter(items)), 100)) == len(rooms)


def test_plan_does_not_grow_with_the_corpus():
    counts = {length: 1_000_000 + 7 * length for length in range(1, 1025)}
    patterns = plan(counts)
    assert len(patterns) < 20_000
    assert sum(n for _, n in patterns) <= 1.001 * sum(k * n for k, n in counts.items()) / 1024 + 1


def test_awkward_rows(awkward, no_documents):
    rows = packed(awkward, *FILES).collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in awkward.collect())
    assert packed(no_documents, *FILES).count() == 0
    ids = packed(awkward, *FILES, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in ids)
