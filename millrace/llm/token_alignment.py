"""Alignment of two tokenizers over a corpus: which tokens of one cover the bytes of which of the other.

Both tokenizers cut a text wherever a single space stands between two other characters, so texts are
aligned chunk by chunk and a chunk's alignment is remembered. Nearly all links are counted without a
shuffle: an id of A has one id of B with the same bytes (the identity map), and pairs of that map are
counted in vectors as long as A's vocabulary. Only the other pairs are shuffled, once per document.
"""

from __future__ import annotations

import hashlib
import json
import re
import secrets
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.texts import byte_alphabet, of_worker, stored

# Chunks a worker remembers, none longer than this, with so many links in all.
CACHE_CHUNKS, CACHED_LENGTH, CACHE_LINKS = 400_000, 64, 8_000_000
# Work is cut to these sizes.
CHUNKS_AT_ONCE, CHARACTERS_AT_ONCE = 2_048, 500_000
# The most frequent pairs, whose counts are broadcast (16 bytes each); the counts of others are joined.
FREQUENT_PAIRS = 1 << 18
# Pairs are one number: id of A, then id of B.
SHIFT = np.int64(32)

COUNT_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


class Vocabularies:
    """The bytes of both vocabularies' ids and the identity map; -1 where no id of B has the same bytes."""

    def __init__(self, bpe_file: str, piece_file: str):
        import sentencepiece

        with open(bpe_file, encoding="utf-8") as file:
            tokenizer = json.load(file)
        of = {character: byte for byte, character in enumerate(byte_alphabet())}
        entries = {i: bytes(of[c] for c in token) for token, i in tokenizer["model"]["vocab"].items()}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.b_bytes = []
        for i in range(pieces.get_piece_size()):
            piece = pieces.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
        # Of ids with the same bytes the last counts: pieces come after single bytes.
        by_bytes = {data: i for i, data in enumerate(self.b_bytes) if not (pieces.is_control(i) or pieces.is_unknown(i))}
        self.same = np.asarray([by_bytes.get(data, -1) if data else -1 for data in self.a_bytes], dtype=np.int64)


class Chunks(dict):
    """Numbers of chunks whose alignment is known; tables by number hold it.

    A chunk stands for a space and itself: the space before it, or the one that both tokenizers see
    at a text's start. ``INVALID`` is the number of every chunk whose tokens do not spell its bytes.
    """

    CUT = re.compile(r"(?<=\S) (?=\S)")
    INVALID = 0

    def __init__(self, bpe_file: str, ranks_file: str, piece_file: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        super().__init__()
        self.vocabularies = Vocabularies(bpe_file, piece_file)
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if any(self.vocabularies.a_bytes[rank] != token for token, rank in ranks.items()):
            raise ValueError("the two files of the byte vocabulary differ")
        # No special tokens: their strings are plain text.
        self.a = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.a_sizes = np.asarray([len(x) for x in self.vocabularies.a_bytes])
        self.b_sizes = np.asarray([len(x) for x in self.vocabularies.b_bytes])
        # An id as text, and what may follow it: the next id of its side, the other side, the next group.
        self.a_text, self.b_text = ([[f"{i}{mark}" for i in range(n)] for mark in ends] for n, ends in ((len(self.a_sizes), ",|"), (len(self.b_sizes), ",;")))
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.n_a, self.n_b, self.groups, self.starts = [0], [0], [""], [0, 0]
        self.links = np.zeros(1 << 16, dtype=np.int64)

    def make_room(self) -> None:
        """Numbers stay valid until this is called."""
        if len(self.groups) >= CACHE_CHUNKS or self.starts[-1] >= CACHE_LINKS:
            self.forget()

    def cut(self, text: str) -> list[str]:
        chunks = text.split(" ")
        return chunks if chunks == text.split() else self.CUT.split(text)

    def learn(self, chunks: list[str]) -> None:
        """Align new chunks together, but those alone that begin or end with white space."""
        whole, others = [], []
        for chunk in chunks:
            (others if chunk[0].isspace() or chunk[-1].isspace() else whole).append(chunk)
        for start in range(0, len(whole), CHUNKS_AT_ONCE):
            self._align(whole[start : start + CHUNKS_AT_ONCE])
        for chunk in others:
            self._align([chunk])

    def _align(self, chunks: list[str]) -> None:
        """Add chunks that stand one after the other in a text, where both tokenizers cut between them.

        Every stretch between two neighbouring ends, whichever tokenizer's, is the overlap of one pair.
        """
        text = " ".join(chunks)
        data = b" " + text.encode("utf-8", "surrogatepass")
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        if any(b"".join(map(table.__getitem__, ids)) != data for table, ids in ((self.vocabularies.a_bytes, a), (self.vocabularies.b_bytes, b))):
            if len(chunks) == 1:
                self[chunks[0]] = self.INVALID
            for half in (chunks[: len(chunks) // 2], chunks[len(chunks) // 2 :]):
                if len(chunks) > 1:
                    self._align(half)
            return
        a_ids, b_ids = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        ends, common = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends, assume_unique=True)
        links = (a_ids[np.searchsorted(a_ends, ends)] << SHIFT) | b_ids[np.searchsorted(b_ends, ends)]

        # Ids as text in the order of the groups: ids of A after those of B in earlier groups, ids of B after those of A in theirs.
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        words = np.empty(len(a) + len(b), dtype=object)
        words[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = [self.a_text[e][i] for e, i in zip(np.isin(a_ends, common, assume_unique=True).tolist(), a, strict=True)]
        words[np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")] = [self.b_text[e][i] for e, i in zip(np.isin(b_ends, common, assume_unique=True).tolist(), b, strict=True)]

        edges = np.cumsum([len(c.encode("utf-8", "surrogatepass")) + 1 for c in chunks])
        a_edges, b_edges, link_edges = (np.searchsorted(e, edges) + 1 for e in (a_ends, b_ends, ends))
        word_edges = [0, *(a_edges + b_edges).tolist()]
        listed = words.tolist()
        first, held = len(self.groups), self.starts[-1]
        self.groups += ["".join(listed[x:y])[:-1] for x, y in zip(word_edges, word_edges[1:], strict=False)]
        self.n_a += np.diff(a_edges, prepend=0).tolist()
        self.n_b += np.diff(b_edges, prepend=0).tolist()
        self.starts += (held + link_edges).tolist()
        while held + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[held : held + len(links)] = links
        self.update(zip(chunks, range(first, first + len(chunks)), strict=True))

    def documents(self, texts: list[str | None]) -> list[tuple[tuple[int, int, int, int], str, np.ndarray]]:
        """Per text its counts, digest of the groups, and links; zeros, '' and none where it has no tokens."""
        split = [self.cut(text) if text else [] for text in texts]
        found = [list(map(self.get, chunks)) for chunks in split]
        new = list(dict.fromkeys(c for chunks, numbers in zip(split, found, strict=True) if None in numbers for c, n in zip(chunks, numbers, strict=True) if n is None))
        self.learn(new)
        starts = np.asarray(self.starts)
        out = []
        for chunks, numbers in zip(split, found, strict=True):
            if None in numbers:
                numbers = list(map(self.__getitem__, chunks))
            if not numbers or self.INVALID in numbers:
                out.append(((0, 0, 0, 0), "", self.links[:0]))
                continue
            n_a, n_b = (sum(map(n.__getitem__, numbers)) for n in (self.n_a, self.n_b))
            digest = hashlib.sha256(";".join(map(self.groups.__getitem__, numbers)).encode()).hexdigest()
            at = np.asarray(numbers)
            sizes = starts[at + 1] - starts[at]
            links = self.links[np.repeat(starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
            # A group has one link more than it has inner ends.
            out.append(((n_a, n_b, n_a + n_b - len(links), len(links)), digest, links))
        for chunk in new:
            if len(chunk) > CACHED_LENGTH:
                del self[chunk]
        self.make_room()
        return out


def _groups_of_texts(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column, some at a time."""
    held, size = [], 0
    for value in column:
        text = value.as_py()
        held.append(text)
        size += len(text or "")
        if size >= CHARACTERS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


ALIGNED_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same array<int>, same_times array<int>, pairs array<long>, times array<int>"


def aligned(documents: DataFrame, bpe_file: str, ranks_file: str, piece_file: str) -> DataFrame:
    """Per document its counts and digest, and its distinct links with how often it has them.

    ``same`` holds the ids of A that are linked with their identity, ``pairs`` all other pairs.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = of_worker(("chunks", bpe_file, ranks_file, piece_file), lambda: Chunks(bpe_file, ranks_file, piece_file))
        same = chunks.vocabularies.same
        for batch in batches:
            columns: list[list] = [[] for _ in range(9)]
            for counts, digest, links in (row for texts in _groups_of_texts(batch.column(1)) for row in chunks.documents(texts)):
                keys, times = np.unique(links, return_counts=True)
                a = keys >> SHIFT
                identical = same[a] == (keys & ((1 << SHIFT) - 1))
                values = (*counts, digest, a[identical].astype(np.int32), times[identical].astype(np.int32), keys[~identical], times[~identical].astype(np.int32))
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names)

    types = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [f.split()[0] for f in ALIGNED_SCHEMA.split(", ")]
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, ALIGNED_SCHEMA)


def same_counts(links: DataFrame, size: int) -> np.ndarray:
    """How many documents link each id of A with its identity; every task sends one vector's entries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["a", "n"])

    summed = links.select("same").mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).toArrow()  # at most the vocabulary
    out = np.zeros(size, dtype=np.int64)
    out[summed.column("a").to_numpy()] = summed.column("n").to_numpy()
    return out


def pair_counts(links: DataFrame) -> DataFrame:
    """How many documents have each pair beyond the identity map."""
    return links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def highest_counts(counts: DataFrame, same: np.ndarray) -> np.ndarray:
    """Per id of A the highest count among its pairs."""
    found = counts.groupBy(F.shiftright("pair", int(SHIFT)).alias("a")).agg(F.max("n").alias("n")).toArrow()  # at most the vocabulary
    best = same.copy()
    a = found.column("a").to_numpy()
    best[a] = np.maximum(best[a], found.column("n").to_numpy())
    return best


def frequent_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in ascending order, and their counts, above a count that at most ``most`` pairs reach."""
    level = F.floor(F.log2("n") * 32).cast("int")
    total, lowest = 0, None
    for row in counts.groupBy(level.alias("level")).agg(F.count("*").alias("pairs")).orderBy(F.desc("level")).collect():  # 32 per power of two
        total += row["pairs"]
        if total > most:
            break
        lowest = row["level"]
    if lowest is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows = counts.filter(level >= lowest).toArrow()
    pairs = rows.column("pair").to_numpy()
    order = np.argsort(pairs)
    return pairs[order], rows.column("n").to_numpy()[order]


def token_alignment(documents: DataFrame, bpe_file: str, ranks_file: str, piece_file: str, frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are NULL or empty, or that either tokenizer does not give back byte for byte, have no
    tokens: zeros and an empty digest. Repeated rows, and rows that share an id or have none, are
    documents of their own and count so. No documents, no rows.
    """
    spark = documents.sparkSession
    links = stored(aligned(documents, bpe_file, ranks_file, piece_file), "aligned")
    size = len(Vocabularies(bpe_file, piece_file).a_bytes)
    counts = stored(pair_counts(links), "pair-counts")
    same = same_counts(links, size)
    best = highest_counts(counts, same)

    tables = spark.sparkContext.broadcast((same, best, *frequent_pairs(counts, frequent)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, best, known, known_n = tables.value
        for batch in batches:
            chunk, nth = np.full(batch.num_rows, secrets.randbits(62)), np.arange(batch.num_rows)
            a, a_times, pairs, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("same", "same_times", "pairs", "times"))
            documents = [np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch.column(c)))) for c in ("same", "pairs")]
            at = np.searchsorted(known, pairs)
            hit = np.zeros(len(pairs), dtype=bool)
            hit[at < len(known)] = known[at[at < len(known)]] == pairs[at < len(known)]
            n = known_n[at[hit]]
            of = np.concatenate([documents[0], documents[1][hit]])
            value = np.concatenate([same[a], n])
            weight = np.concatenate([a_times, times[hit]])
            ids = np.concatenate([a, pairs[hit] >> SHIFT])
            sums = np.zeros((2, batch.num_rows), dtype=np.int64)
            np.add.at(sums[0], of, weight * (value == best[ids]))
            np.add.at(sums[1], of, weight * value)
            rest = documents[1][~hit]
            offsets = np.searchsorted(rest, np.arange(batch.num_rows + 1)).astype(np.int32)
            left = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)) for v in (pairs[~hit], times[~hit])]
            kept = [batch.column(c) for c in ("doc_id", *COUNT_COLUMNS, "groups_sha256")]
            yield pa.RecordBatch.from_arrays([pa.array(chunk), pa.array(nth), *kept, pa.array(sums[0]), pa.array(sums[1]), *left], names)

    names = ["chunk", "nth", "doc_id", *COUNT_COLUMNS, "groups_sha256", "n_best", "count_sum", "rare", "times"]
    schema = "chunk long, nth long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rare array<long>, times array<long>"
    scored = stored(links.mapInArrow(score, schema), "scored-alignments")
    # Links whose pair is not among the frequent ones get their counts from the table of all pairs.
    rare = scored.select("chunk", "nth", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("chunk", "nth", F.col("r.rare").alias("pair"), F.col("r.times").alias("times"))
    highest = spark.createDataFrame(pa.table({"a": np.flatnonzero(best), "highest": best[best > 0]}), T.StructType([T.StructField("a", T.LongType()), T.StructField("highest", T.LongType())]))
    counted = rare.join(counts, "pair").join(F.broadcast(highest), F.shiftright("pair", int(SHIFT)) == F.col("a"))
    added = counted.groupBy("chunk", "nth").agg(F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    joined = scored.drop("rare", "times").join(stored(added, "rare-links"), ["chunk", "nth"], "left")
    return joined.select(
        "doc_id", *COUNT_COLUMNS, *[(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))], "groups_sha256"
    )


def frequent_links(spark: SparkSession, documents: DataFrame, bpe_file: str, ranks_file: str, piece_file: str) -> DataFrame:
    """a, b and n of all linked pairs: the table for mapping one vocabulary to the other."""
    links = stored(aligned(documents, bpe_file, ranks_file, piece_file), "aligned")
    vocabularies = Vocabularies(bpe_file, piece_file)
    same = same_counts(links, len(vocabularies.a_bytes))
    used = np.flatnonzero(same)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "n")])
    identical = spark.createDataFrame(pa.table({"a": used, "b": vocabularies.same[used], "n": same[used]}), schema)
    others = pair_counts(links).select(F.shiftright("pair", int(SHIFT)).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << int(SHIFT)) - 1)).alias("b"), "n")
    return identical.unionByName(others)
