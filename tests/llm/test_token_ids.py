"""Token-id files: round trips, and offsets against plain sums."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import awkward, no_documents  # noqa: F401
from tokenizers import Tokenizer

from millrace.llm import token_ids
from millrace.llm.queries import op12_token_id_files
from millrace.session import scratch

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def brute(tokenizer, rows):
    """(doc_id, start, n_tokens, crc) with rows of one id in any order; so these are compared by their ends."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def in_order(df):
    return [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.orderBy("start").collect()]


def test_query_equals_whole_texts(spark, tokenizer):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    assert in_order(op12_token_id_files(spark, SF_DIR)) == brute(tokenizer, rows)


@pytest.mark.parametrize("file_ids", [1, 50, 1 << 20])
def test_awkward_rows(spark, tokenizer, awkward, file_ids):  # noqa: F811
    got = in_order(token_ids.written_and_read(awkward.repartition(3), FILE, file_ids))
    rows = sorted(awkward.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert got == brute(tokenizer, rows)


def test_rows_that_share_an_id_keep_their_own_texts(spark, tokenizer):
    rows = [(4, "one two"), (4, "three"), (None, "no id"), (None, None), (4, "one two"), (-(2**63), "least"), (2**63 - 1, "most")]
    got = in_order(token_ids.written_and_read(spark.createDataFrame(rows, "doc_id long, text string"), FILE))
    assert [r[0] for r in got] == [None, None, -(2**63), 4, 4, 4, 2**63 - 1]
    assert sorted((r[0] is None, r[0] or 0, r[2], r[3]) for r in got) == sorted((d is None, d or 0, n, c) for d, _, n, c in brute(tokenizer, rows))
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()


def test_no_documents_no_rows(spark, no_documents):  # noqa: F811
    assert token_ids.written_and_read(no_documents, FILE).count() == 0


def test_ids_come_back_from_files(spark, tokenizer):
    path = scratch(spark, "test-token-ids")
    texts = {1: "Hello, World's <|endoftext|> end", 2: "", 3: "naïve café ẞtraße ΟΔΟΣ İstanbul"}
    token_ids.write_ids(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path, FILE, end_id=7)
    got = {r["doc_id"]: r["ids"] for r in token_ids.read_ids(spark, path, with_ids=True).collect()}
    assert got == {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 7] for k, t in texts.items()}
    assert spark.read.format("binaryFile").load(path).filter("length > 0").count() >= 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85  ΣσςİI'’`´̈̀́<|endoftext|>")), max_size=60))
def test_words_are_encoded_as_in_the_whole_text(tokenizer, text):
    words = token_ids.WordIds(FILE) if not hasattr(test_words_are_encoded_as_in_the_whole_text, "words") else test_words_are_encoded_as_in_the_whole_text.words
    test_words_are_encoded_as_in_the_whole_text.words = words
    assert np.frombuffer(words.encode(text.encode()), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50), max_size=400))
def test_sequences_come_back_by_position(values):
    values = np.sort(np.asarray(values, dtype=np.uint64))
    back = token_ids.EliasFano.from_bytes(token_ids.EliasFano.of(values).to_bytes())
    order = np.random.default_rng(len(values)).permutation(len(values))
    assert (back.select(order) == values[order]).all()


def test_boundaries_take_little_space():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 500, 100_000))
    size = len(token_ids.EliasFano.of(ends).to_bytes())
    assert size * 8 / len(ends) < 2.5 + np.log2(ends[-1] / len(ends))


def test_a_damaged_file_raises():
    data = bytearray(token_ids.file_bytes(0, 0, [1, 2], [b"\1\0", b"\2\0\1\0"], 2))
    assert token_ids.TokenFile(bytes(data) + b"\n").n_ids == 3
    data[-6] ^= 1
    with pytest.raises(ValueError, match="whole file"):
        token_ids.TokenFile(bytes(data))


def test_descending_numbers_raise():
    with pytest.raises(ValueError, match="ascend"):
        token_ids.EliasFano.of(np.asarray([2, 1]))


def test_a_small_cache_changes_nothing(tokenizer):
    small = token_ids.WordIds(FILE, bound=6)
    for text in ["one two, three four five", "six one two seven eight nine ten eleven", "one, two! x" + "y" * 100, "two two two"] * 2:
        assert np.frombuffer(small.encode(text.encode()), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(small) <= 16
