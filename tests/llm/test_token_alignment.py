"""Token alignment against a plain version that compares every token with every other."""

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_DIR
from llm_rows import awkward, no_documents  # noqa: F401
from tokenizers import Tokenizer

from millrace.llm import token_alignment
from millrace.llm.queries import op13_token_alignment

FILES = tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")))
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    """Both tokenizers on whole texts, and their tokens' bytes."""

    def __init__(self):
        self.a = Tokenizer.from_file(FILES[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
        # The byte-level alphabet, read off the tokenizer's own decoder.
        of, n = {}, 0
        for byte in range(256):
            if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
                of[chr(byte)] = byte
            else:
                of[chr(256 + n)] = byte
                n += 1
        vocabulary = json.load(open(FILES[0], encoding="utf-8"))["model"]["vocab"]
        self.a_bytes = {i: bytes(of[c] for c in t) for t, i in vocabulary.items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(self, ids, data_of):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(data_of(i))))
            at = out[-1][2]
        return out

    def links(self, text):
        if not text:
            return None
        data = (" " + text).encode()
        a = self.spans(self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes.__getitem__)
        b = self.spans(self.b.encode(text), self.b_bytes)
        if b"".join(self.a_bytes[i] for i, _, _ in a) != data or b"".join(self.b_bytes(i) for i, _, _ in b) != data:
            return None
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        number = {cut: n for n, cut in enumerate(cuts)}
        sides = []
        for side in (a, b):
            own, parts = [], [[] for _ in cuts]
            for i, _, e in side:
                own.append(str(i))
                if e in number:
                    parts[number[e]], own = own, []
            sides.append([",".join(p) for p in parts])
        groups = ["|".join(g) for g in zip(*sides, strict=True)]
        links, first = [], 0
        for i, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            j = first
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        return len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def rows(self, documents):
        found = [self.links(t) for _, t in documents]
        counts = Counter(pair for f in found if f for pair in set(f[3]))
        best = defaultdict(int)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        out = []
        for (doc_id, _), f in zip(documents, found, strict=True):
            if f is None:
                out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            else:
                out.append((doc_id, *f[:3], len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), f[4]))
        return sorted(out, key=str)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_equals_the_plain_version(spark, plain):
    documents = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op13_token_alignment(spark, SF_DIR)) == plain.rows(documents)


TEXTS = [
    "two  spaces,   three \n\n lines\t\tand tabs ", " leading", "trailing ", "  ", "\n", "a▁b c", "<|endoftext|> and <s> </s> <0x41> <unk>",
    "ﬁ ½ é é 　 wide \x00 nul \x1c x\x1c y", "naïve 東京 \U0001f600\U0001f9d1‍\U0001f4bb", "a a a aa aaa aaaa", "don't we'll 1234567 3.14159", "x", "\x85 a b",
]


def test_awkward_texts(spark, plain, awkward):  # noqa: F811
    extra = [(i, t) for i, t in enumerate(TEXTS, start=100)] + [(None, "same row twice"), (100, "another text of an id")]
    frame = awkward.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    documents = [(r["doc_id"], r["text"]) for r in frame.collect()]
    wanted = plain.rows(documents)
    for frequent in (0, 40, 1 << 18):  # all, most and none of the other pairs are joined
        assert rows_of(token_alignment.token_alignment(frame.repartition(3), *FILES, frequent=frequent)) == wanted


def test_a_forgetful_cache_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(token_alignment, "CACHE_CHUNKS", 3)
    monkeypatch.setattr(token_alignment, "CACHED_LENGTH", 4)
    chunks = token_alignment.Chunks(*FILES)
    assert [r[1] for r in chunks.documents(TEXTS)] == [(plain.links(t) or [""])[-1] for t in TEXTS]
    for text in TEXTS * 2:
        wanted = plain.links(text)
        counts, digest, links = chunks.documents([text])[0]
        if wanted is None:
            assert (counts, digest, len(links)) == ((0, 0, 0, 0), "", 0)
        else:
            assert (*counts, digest) == (*wanted[:3], len(wanted[3]), wanted[4])
            assert [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in links] == wanted[3]


def test_a_link_of_the_identity_map_counts_once_per_document(spark, plain):
    """The same pair inside and outside one-to-one groups, in one document and in several."""
    documents = [(1, "aaaa aaa aa a aaaaa"), (2, "a"), (3, "aa"), (4, "aaaa aaa aa a aaaaa")]
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    assert rows_of(token_alignment.token_alignment(frame, *FILES)) == plain.rows(documents)
    counts = {(r["a"], r["b"]): r["n"] for r in token_alignment.frequent_links(spark, frame, *FILES).collect()}
    assert counts == Counter(pair for _, t in documents for pair in set(plain.links(t)[3]))


def test_no_documents_no_rows(spark, no_documents):  # noqa: F811
    assert token_alignment.token_alignment(no_documents, *FILES).count() == 0


def test_no_cut_joins_what_either_vocabulary_joins():
    """Chunks end before a space between other characters: no piece goes on beyond such a place."""
    assert not [d for d in token_alignment.Vocabularies(*FILES[::2]).b_bytes if b" " in d.lstrip(b" ")]
