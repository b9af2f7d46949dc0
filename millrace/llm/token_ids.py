"""Token ids of a corpus in binary files, with document boundaries in Elias-Fano form.

The ids of all documents, in ascending order of doc_id, are one long array that is cut into files at
documents. A file holds its ids at the width the vocabulary needs, the ends of its documents and their
doc_ids. Both are ascending sequences and stored in Elias-Fano form: the low bits of each number
packed, the high bits in unary, and a directory of how many ones come before each stretch of the
unary bits. So the offset of a document is found without decoding the others, at about two bits and
the low bits per document.

Files are written by Spark's text sink, one record per file, and read by its binaryFile source, so
they live wherever Spark can write.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.texts import byte_alphabet, of_worker, scratch, stored

END_ID = 1
# A file ends with the document that reaches one of these; a document is never cut.
FILE_IDS, FILE_DOCUMENTS = 1 << 23, 1 << 20
CACHE_WORDS = 400_000
# Longer words are encoded each time.
CACHED_LENGTH = 64
# Letters below this have no form but their own and one lower-case letter.
LATIN_END = "\u0250"

MAGIC = b"EFTOKENS"
# Width of an id; task that wrote the file and ids the task wrote before it; documents, those of them
# without id, first id, number of ids; bytes of the two sequences.
HEAD = "<8sHQQQQqQQQ"
# Ones are counted per stretch of so many bytes of the unary bits.
STRETCH = 64

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
POPCOUNT = _ONES.sum(axis=1).astype(np.int64)
# The place of the k-th one in a byte.
PLACE = np.stack([np.where((np.cumsum(_ONES, axis=1) == k + 1) & (_ONES == 1), np.arange(8), 0).max(axis=1) for k in range(8)], axis=1).astype(np.int64)


class EliasFano:
    """An ascending sequence of unsigned 64-bit numbers with access by position.

    ``to_bytes`` and ``from_bytes`` are its form in a file: count, width of the low bits, and sizes,
    then low bits, unary bits and directory.
    """

    HEAD = "<QBQQ"

    def __init__(self, count: int, width: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.count, self.width, self.low, self.high, self.directory = count, width, low, high, directory

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("an Elias-Fano sequence must ascend")
        width = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) + 1 + 8 * STRETCH) // (8 * STRETCH) * STRETCH if n else 0, dtype=np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        bits = np.zeros(n * width, dtype=np.uint8)
        for bit in range(width):
            bits[bit::width] = (values >> np.uint64(bit)) & np.uint64(1)
        low = np.packbits(bits, bitorder="little")
        before = np.cumsum(POPCOUNT[high].reshape(-1, STRETCH).sum(axis=1))
        return cls(n, width, low, high, np.concatenate([[0], before[:-1]]).astype("<u4") if n else np.zeros(0, "<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack(self.HEAD, self.count, self.width, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.directory.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        count, width, n_low, n_high = struct.unpack_from(cls.HEAD, data)
        at = struct.calcsize(cls.HEAD)
        low, high = (np.frombuffer(data, np.uint8, n, o) for n, o in ((n_low, at), (n_high, at + n_low)))
        return cls(count, width, low, high, np.frombuffer(data, "<u4", n_high // STRETCH, at + n_low + n_high))

    def select(self, positions: np.ndarray) -> np.ndarray:
        """The values at some positions: the directory names the stretch, its bytes are counted, a table ends it."""
        positions = np.asarray(positions, dtype=np.int64)
        if not len(positions):
            return np.zeros(0, dtype=np.uint64)
        stretch = np.searchsorted(self.directory, positions, side="right") - 1
        left = positions - self.directory[stretch]
        counted = np.cumsum(POPCOUNT[self.high.reshape(-1, STRETCH)[stretch]], axis=1)
        byte = (counted <= left[:, None]).sum(axis=1)
        left -= np.where(byte > 0, counted[np.arange(len(left)), byte - 1], 0)
        place = PLACE[self.high[stretch * STRETCH + byte], left]
        upper = ((stretch * STRETCH + byte) * 8 + place - positions).astype(np.uint64)
        return (upper << np.uint64(self.width)) | self._low(positions)

    def _low(self, positions: np.ndarray) -> np.ndarray:
        out = np.zeros(len(positions), dtype=np.uint64)
        for bit in range(self.width):
            at = positions * self.width + bit
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(bit)
        return out


class WordIds(dict):
    """Ids of words (bytes), little-endian, at the width of the vocabulary.

    The vocabulary's tokenizer drops white space and never joins what it parts, so a text's ids are
    those of its words. Words of a text that are not yet known are encoded together.
    """

    def __init__(self, tokenizer_file: str, bound: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a worker for each core
        from tokenizers import Tokenizer

        super().__init__()
        self.bound = bound
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.alphabet = byte_alphabet()
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def encoded(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Words with their ids. Latin letters alone are one entry of the model; others take all of its steps."""
        tokenize, byte = self.tokenizer.model.tokenize, self.alphabet.__getitem__
        plain, others, ids, edges = [], [], [], [0]
        for word in words:
            if word.isalpha():  # of bytes: ASCII letters
                spelled = word.lower().decode()
            else:
                letters = word.decode("utf-8", "replace")
                lower = letters.lower()
                if not (letters.isalpha() and max(letters) < LATIN_END and lower.isalpha()):
                    others.append(word)
                    continue
                spelled = "".join(map(byte, lower.encode()))
            plain.append(word)
            ids += [token.id for token in tokenize(spelled)]
            edges.append(len(ids))
        yield from self._parted(plain, ids, np.asarray(edges))
        for start in range(0, len(others), 4096):
            part = others[start : start + 4096]
            found = self.tokenizer.encode([w.decode("utf-8", "replace") for w in part], is_pretokenized=True, add_special_tokens=False)
            yield from self._parted(part, found.ids, np.searchsorted(np.asarray(found.word_ids, dtype=np.int64), np.arange(len(part) + 1)))

    def _parted(self, words: list[bytes], ids: list[int], edges: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        """Words with their share of the ids, which ends at the next edge."""
        data = np.asarray(ids, dtype=f"<u{self.width}").tobytes()
        at = (edges * self.width).tolist()
        return zip(words, map(data.__getitem__, map(slice, at[:-1], at[1:])), strict=True)

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new words. Marks after a letter or digit are entries of their own: no token spans that place."""
        parts, ended = [], []
        for word in words:
            core = word if word.isalpha() else word.rstrip(b".,;:!?")
            if len(core) < len(word) and core[-1:].isalnum():
                marks = word[len(core) :]
                ended.append((word, core, marks))
                parts += (core, marks)
            else:
                parts.append(word)
        new = dict(self.encoded([part for part in dict.fromkeys(parts) if part not in self]))
        for word, core, marks in ended:
            new[word] = (new[core] if core in new else self[core]) + (new[marks] if marks in new else self[marks])
        return new

    def encode(self, text: bytes) -> bytes:
        # What may hold a special token, which is told by its case, is left as it is.
        words = (text if b"<|" in text else text.lower()).split()
        ids = list(map(self.get, words))
        if None in ids:
            new = self.learn(list(dict.fromkeys([w for w, i in zip(words, ids, strict=True) if i is None])))
            ids = [new[w] if i is None else i for w, i in zip(words, ids, strict=True)]
            if len(self) + len(new) > self.bound:  # forget the older half
                for word in list(islice(self, len(self) // 2 if len(new) < self.bound // 2 else None)):
                    del self[word]
            self.update(new if len(max(new, key=len)) <= CACHED_LENGTH else {w: i for w, i in new.items() if len(w) <= CACHED_LENGTH})
        return b"".join(ids)


def file_bytes(task: int, before: int, doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One file: documents in order (those without id first) with their ids."""
    known = np.asarray([d for d in doc_ids if d is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    names = EliasFano.of(known.view(np.uint64) - np.int64(first).view(np.uint64)).to_bytes()
    ends = np.cumsum([len(i) // width for i in ids])
    boundaries = EliasFano.of(ends).to_bytes()
    head = struct.pack(HEAD, MAGIC, width, task, before, len(ids), len(ids) - len(known), first, int(ends[-1]), len(boundaries), len(names))
    body = b"".join([head, boundaries, names, *ids])
    return body + struct.pack("<I", zlib.crc32(body))


class TokenFile:
    """A file in memory; documents are numbered from 0 within it."""

    def __init__(self, data: bytes):
        magic, width, self.task, self.before, self.n_docs, self.n_null, self.first, self.n_ids, n_ends, n_names = struct.unpack_from(HEAD, data)
        head = struct.calcsize(HEAD)
        names = head + n_ends
        start = names + n_names
        stop = start + width * self.n_ids
        if magic != MAGIC or len(data) < stop + 4 or struct.unpack_from("<I", data, stop)[0] != zlib.crc32(memoryview(data)[:stop]):
            raise ValueError("not a whole file of token ids")
        self.ends = EliasFano.from_bytes(data[head:names])
        self.names = EliasFano.from_bytes(data[names:start])
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, start)

    def offsets(self, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the documents start and stop in ``ids``."""
        stops = self.ends.select(documents).astype(np.int64)
        starts = np.zeros(len(documents), dtype=np.int64)
        later = documents > 0
        starts[later] = self.ends.select(documents[later] - 1)
        return starts, stops

    def doc_ids(self, documents: np.ndarray) -> list[int | None]:
        known = documents >= self.n_null
        found = (self.names.select(documents[known] - self.n_null) + np.int64(self.first).view(np.uint64)).view(np.int64)
        return [None] * int((~known).sum()) + found.tolist()


def write_ids(documents: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> None:
    """Encode whole texts and write their ids, each text's followed by ``end_id``, in ascending order of doc_id.

    Rows without id come first; rows that share an id are ordered by a hash of their text. A text that
    is NULL or empty is its end id alone. The sort deals out rows by (doc_id, hash, a number of the
    row), so that many rows with one id still go to many tasks.
    """

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = of_worker(("word ids", tokenizer_file), lambda: WordIds(tokenizer_file))
        end = np.asarray([end_id], dtype=f"<u{words.width}").tobytes()
        task, before, held, names, ids = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                names.append(doc_id.as_py())
                ids.append(words.encode(text.as_py() or b"") + end)
                held += len(ids[-1]) // words.width
                if held >= file_ids or len(ids) >= FILE_DOCUMENTS:
                    yield pa.RecordBatch.from_arrays([pa.array([file_bytes(task, before, names, ids, words.width)], pa.binary())], ["file"])
                    before, held, names, ids = before + held, 0, [], []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([file_bytes(task, before, names, ids, words.width)], pa.binary())], ["file"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    keys = ("doc_id", "tie", "nth")
    keyed = rows.withColumns({"tie": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    # Spark strings are bytes: the cast checks nothing, and the sink writes them as they are, one per file.
    ordered.mapInArrow(files, "file binary").select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: task, place among the task's ids, doc_id, n_tokens, ids_crc32; ``ids`` if asked for."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_py())
                for first in range(0, file.n_docs, 65_536):
                    documents = np.arange(first, min(first + 65_536, file.n_docs))
                    starts, stops = file.offsets(documents)
                    parts = [file.ids[a:b] for a, b in zip(starts, stops, strict=True)]
                    columns = [
                        pa.array(np.full(len(documents), file.task)), pa.array(starts + file.before), pa.array(file.doc_ids(documents), pa.int64()),
                        pa.array(stops - starts), pa.array([zlib.crc32(p.astype("<u4")) for p in parts], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["task", "place", "doc_id", "n_tokens", "ids_crc32", "ids"][: 5 + with_ids]
    schema = "task long, place long, doc_id long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    found = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    return found.mapInArrow(parse, schema)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    rows = stored(read_files(spark, path, with_ids), "token-documents")
    # One row per task that wrote: the ids of all tasks before it.
    totals = rows.groupBy("task").agg(F.sum("n_tokens").alias("n")).orderBy("task").collect()
    starts = np.concatenate([[0], np.cumsum([r["n"] for r in totals])]).tolist()
    tasks = spark.createDataFrame([(r["task"], start) for r, start in zip(totals, starts, strict=False)], "of_task long, first long")
    joined = rows.join(F.broadcast(tasks), F.col("task") == F.col("of_task"))
    return joined.select("doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def written_and_read(documents: DataFrame, tokenizer_file: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the documents' ids to a new folder in the shared folder and read them back. No documents, no rows."""
    spark = documents.sparkSession
    path = scratch(spark, "token-ids")
    write_ids(documents, path, tokenizer_file, file_ids=file_ids)
    return read_ids(spark, path)
