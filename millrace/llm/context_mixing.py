"""Language-model scores by online logistic context mixing.

A token is coded bit by bit: words of a bounded vocabulary along their Huffman code, any other word
as an escape followed by its bytes. Each bit is predicted in several contexts; a context and the
place in the code are hashed to a slot with the counts of zeros and ones seen there in training.
The logits of the predictors are mixed by weights. How much the contexts have seen selects (gates)
the set of weights, and every document refines the sets it uses after each block of its tokens, on
what it has just coded. So the mixture is a proper sequential model; its log-probability of a text,
in bits and divided by the text's bytes, is the bits per byte.

Tables have a fixed size; their counts and the weights come from all training documents. Words outside the
vocabulary have their exact corpus counts joined from the table of all words.
"""

from __future__ import annotations

import heapq
import secrets
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import count as counter
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.labelled import remainder
from millrace.llm.texts import stored

DIVISOR, HELD_OUT = 5, 1
# At most so many words have a code of their own; this bounds what is broadcast.
VOCABULARY = 1 << 18
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
# Counts of a task travel in pieces of so many numbers, each as one row.
PIECE = 1 << 10
# Contexts of words: none, the last token, the last two. Of bytes: the last one, two, three.
ORDERS = 3
# Count levels of the last two contexts select one of LEVELS ** 2 sets of weights.
LEVEL_STARTS = (1, 4, 32)
LEVELS = len(LEVEL_STARTS) + 1
GATES = LEVELS * LEVELS
BLOCK = 128
RATE, REFINE = 0.5, 0.15
# Work is cut to these sizes, so that memory does not follow the length of texts.
DOCUMENTS_AT_ONCE, TOKENS_AT_ONCE = 256, 65_536
SPELLED_CACHE = 200_000
END, ESCAPE = b" end", b" escape"  # words have no spaces

# Odd multipliers of the 32-bit hashes.
_MIX, _MIX_2, _MIX_3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
LOG10 = float(np.log(10.0))


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column one by one: a batch can be large, its copy in Python need not be."""
    return (value.as_py() for value in column)


def tokens(text: str | None) -> list[bytes]:
    """Words, A-Z in lower case, without the end."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(documents: DataFrame) -> DataFrame:
    """word (binary) and n of all tokens of the documents, ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in _texts(batch.column(0)):
                seen.update(tokens(text))
            seen[END] += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    return documents.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0")


def frequent_words(counts: DataFrame, most: int = VOCABULARY) -> dict[bytes, int]:
    """The words above a count that at most ``most`` words reach, with their counts.

    Words seen once are left out: as escapes they show how often new words come.
    """
    counts = counts.filter((F.col("n") > 1) | (F.col("word") == END))
    level = F.floor(F.log2("n") * 32).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()  # 32 per power of two
    total, lowest = 0, None
    for row in levels:
        total += row["words"]
        if total > most:
            break
        lowest = row["level"]
    if lowest is None:
        return {}
    rows = counts.filter(level >= lowest).toArrow()
    return dict(sorted(zip(rows.column("word").to_pylist(), rows.column("n").to_pylist(), strict=True)))


def _slot(mixed: np.ndarray) -> np.ndarray:
    """The slot of hashed contexts; works in place."""
    mixed ^= mixed >> np.uint32(15)
    mixed *= _MIX_2
    mixed >>= np.uint32(32 - SLOT_BITS)
    return mixed.astype(np.int64)


class Symbols(dict):
    """Numbers of words; any other word has the number of the escape."""

    escape = 0

    def __missing__(self, word: bytes) -> int:
        return self.escape


class Code:
    """Huffman code: per symbol the inner nodes it passes and the bits taken there.

    A place in the code is a symbol's step: its node, hashed; its bit; and the node's logit without
    any context, which the counts of the symbols give.
    """

    def __init__(self, counts: dict[bytes, int], escapes: int = 0):
        self.shared: Broadcast | None = None
        symbols = {**counts, ESCAPE: max(1, escapes)}
        symbols.setdefault(END, 1)
        self.index = Symbols((word, i) for i, word in enumerate(symbols))
        self.index.escape = self.index[ESCAPE]
        self.counts = np.asarray([counts.get(w, 0) for w in symbols], dtype=np.float64)
        order, parents = counter(), {}
        heap = [(n, next(order), i) for i, n in enumerate(symbols.values())]
        heapq.heapify(heap)
        inner = len(symbols)
        while len(heap) > 1:
            (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            parents[left], parents[right] = (inner, 0), (inner, 1)
            heapq.heappush(heap, (a + b, next(order), inner))
            inner += 1
        nodes, bits, starts = [], [], [0]
        for symbol in range(len(symbols)):
            at = symbol
            while at in parents:
                at, bit = parents[at]
                nodes.append(at - len(symbols))
                bits.append(bit)
            starts.append(len(nodes))
        nodes, self.bits = np.asarray(nodes, dtype=np.int64), np.asarray(bits, dtype=np.uint8)
        self.starts = np.asarray(starts, dtype=np.int64)
        self.lengths = np.diff(self.starts)
        times = np.repeat(np.asarray(list(symbols.values()), dtype=np.float64), self.lengths)
        taken = np.bincount(nodes * 2 + self.bits, weights=times, minlength=2 * (len(symbols) - 1)).reshape(-1, 2)
        self.logits = np.log((taken[nodes, 1] + 0.4) / (taken[nodes, 0] + 0.4)).astype(np.float32)
        places = nodes.astype(np.uint32) * _MIX_3
        places ^= places >> np.uint32(15)
        # The lowest bit of a place is the bit taken there, so that one look gives both.
        self.places = ((places * _MIX) & ~np.uint32(1)) | self.bits

    def share(self, spark: SparkSession) -> None:
        """Broadcast the code once; from now on functions that use it carry a reference to that."""
        self.shared = spark.sparkContext.broadcast(self)

    def __reduce_ex__(self, protocol: int) -> tuple:
        return super().__reduce_ex__(protocol) if self.shared is None else (attrgetter("value"), (self.shared,))


def _contexts(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of the last token and of the last two, per token, ready to be added to those of places.

    ``first`` are the first tokens of documents.
    """
    last = np.concatenate([[0], ids[:-1] + 1]).astype(np.uint32)
    last[first] = 0
    before = np.concatenate([[0], last[:-1]]).astype(np.uint32)
    before[first] = 0
    one = last * _MIX + np.uint32(1)
    two = ((one ^ (one >> np.uint32(13))) ^ (before * _MIX_2)) * _MIX + np.uint32(2)
    both = np.stack([one, two])
    both ^= both >> np.uint32(15)
    both *= _MIX_2
    return both


def _steps(code: Code, ids: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Logits without context, slots (per higher order), bits, and code lengths of some tokens."""
    lengths = code.lengths[ids]
    at = np.repeat(code.starts[ids] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    places = code.places.take(at)
    slots = np.empty((len(contexts), len(at)), dtype=np.intp)
    for own, context in zip(slots, contexts, strict=True):
        # Both are mixed already: the high bits of their sum are a hash of the pair.
        mixed = np.repeat(context, lengths)
        mixed += places
        mixed >>= np.uint32(32 - SLOT_BITS)
        own[:] = mixed
    places &= np.uint32(1)
    return code.logits.take(at), slots, places.astype(np.uint8), lengths


def _byte_steps(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots (per order), bits and numbers of bits of words spelled in bytes, each ended by a space."""
    data = np.frombuffer(b" ".join([*words, b""]), dtype=np.uint8).astype(np.uint32)
    sizes = np.asarray([len(w) + 1 for w in words], dtype=np.int64)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    steps = np.arange(8, dtype=np.uint32)
    places = ((np.uint32(256) | data)[:, None] >> (np.uint32(8) - steps)[None, :]) * _MIX_3
    bits = ((data[:, None] >> (np.uint32(7) - steps)[None, :]) & np.uint32(1)).astype(np.uint8).ravel()
    history, slots = np.zeros(len(data), dtype=np.uint32), []
    for back in range(1, ORDERS + 1):
        earlier = np.concatenate([np.zeros(back, np.uint32), data[:-back]])[: len(data)]
        history = (history ^ np.where(place >= back, earlier + np.uint32(1), np.uint32(0))) * _MIX + np.uint32(back)
        slots.append(_slot(((history[:, None] ^ places) * _MIX).ravel()))
    return np.stack(slots), bits, 8 * sizes


def _encoded(code: Code, found: list[bytes]) -> np.ndarray:
    """Symbols of a text's words, and the end."""
    found.append(END)
    return np.fromiter(map(code.index.__getitem__, found), dtype=np.int32, count=len(found))


ENCODED_SCHEMA = "doc_id long, held_out boolean, chunk long, nth long, ids binary, n_bytes long, rare array<binary>, times array<long>"


def encoded(documents: DataFrame, code: Code) -> DataFrame:
    """Per document its symbols (32-bit integers as bytes) and its words outside the vocabulary with their counts.

    Texts are read and cut into words here only; the result is stored. ``chunk`` and ``nth`` together
    name a row, also where ids repeat or are NULL.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = secrets.randbits(62)
            for start in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
                part = slice(start, start + DOCUMENTS_AT_ONCE)
                ids, rare, sizes = [], [], []
                for text in _texts(batch.column(2)[part]):
                    found = tokens(text)
                    own = _encoded(code, found)
                    ids.append(own.tobytes())
                    rare.append(Counter(found[i] for i in np.flatnonzero(own == code.index.escape)))
                    sizes.append(len((text or "").encode("utf-8", "surrogatepass")))
                columns = [
                    batch.column(0)[part], batch.column(1)[part], pa.array(np.full(len(ids), chunk)), pa.array(np.arange(start, start + len(ids))),
                    pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()),
                    pa.array([list(c.keys()) for c in rare], pa.list_(pa.binary())), pa.array([list(c.values()) for c in rare], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "held_out", "chunk", "nth", "ids", "n_bytes", "rare", "times"]
    held_out = remainder(F.col("doc_id"), DIVISOR) == HELD_OUT
    rows = documents.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    return stored(rows.mapInArrow(encode, ENCODED_SCHEMA), "encoded")


def _symbols(column: pa.Array) -> Iterator[np.ndarray]:
    """The symbols of documents one by one, without a copy."""
    return (np.frombuffer(value.as_buffer(), dtype=np.int32) for value in column)


def _coded(code: Code, documents: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Logits without context, slots and bits of all tokens of the documents, about TOKENS_AT_ONCE at a time."""

    def steps() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        whole = np.concatenate(ids)
        sizes = np.asarray([len(own) for own in ids])
        contexts = _contexts(whole, np.cumsum(sizes) - sizes)
        return _steps(code, whole, contexts)[:3]

    ids, held = [], 0
    for whole in documents:
        if len(whole) > TOKENS_AT_ONCE:
            contexts = _contexts(whole, np.zeros(1, dtype=np.int64))
            for start in range(0, len(whole), TOKENS_AT_ONCE):
                part = slice(start, start + TOKENS_AT_ONCE)
                yield _steps(code, whole[part], contexts[:, part])[:3]
            continue
        ids.append(whole)
        held += len(whole)
        if held >= TOKENS_AT_ONCE:
            yield steps()
            ids, held = [], 0
    if held:
        yield steps()


def _add(tables: np.ndarray, slots: np.ndarray, bits: np.ndarray) -> None:
    for table, own in zip(tables, slots, strict=True):
        table += np.bincount(own * 2 + bits, minlength=2 * SLOTS)


TABLE_SCHEMA = "piece long, counts binary"


def _table_rows(pieces: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    numbers, counts = zip(*pieces, strict=True) if (pieces := list(pieces)) else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([c.tobytes() for c in counts], pa.binary())], ["piece", "counts"])


def _pieces(tables: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The pieces of a task's tables that hold any count, with their numbers."""
    return ((i, piece) for i, piece in enumerate(tables.reshape(-1, PIECE)) if piece.any())


def _summed(rows: DataFrame, orders: int) -> np.ndarray:
    """Counts (order, slot, bit) of all tasks; the tables' fixed size reaches the driver at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = held.setdefault(number, np.zeros(PIECE, dtype=np.int64))
                own += np.frombuffer(counts.as_buffer(), dtype=np.int64)
        yield _table_rows(held.items())

    got = rows.repartition("piece").mapInArrow(add, TABLE_SCHEMA).toArrow()
    tables = np.zeros((orders * SLOTS * 2 // PIECE, PIECE), dtype=np.float32)
    for number, counts in zip(got.column("piece").to_pylist(), got.column("counts").to_pylist(), strict=True):
        tables[number] = np.frombuffer(counts, dtype=np.int64)
    return tables.reshape(orders, SLOTS, 2)


def token_tables(learned: DataFrame, code: Code) -> np.ndarray:
    """Counts of the two higher orders over encoded documents; those without context follow from the code."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((ORDERS - 1, 2 * SLOTS), dtype=np.int64)
        for batch in batches:
            for _, slots, bits in _coded(code, _symbols(batch.column(0))):
                _add(tables, slots, bits)
        yield _table_rows(_pieces(tables))

    return _summed(learned.select("ids").mapInArrow(count, TABLE_SCHEMA), ORDERS - 1)


def byte_tables(counts: DataFrame) -> np.ndarray:
    """Counts of spelled words; each word counts once, as rare words do."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((ORDERS, 2 * SLOTS), dtype=np.int64)
        for batch in batches:
            words = batch.column(0).to_pylist()
            for start in range(0, len(words), 8192):
                _add(tables, *_byte_steps(words[start : start + 8192])[:2])
        yield _table_rows(_pieces(tables))

    return _summed(counts.filter(F.col("word") != END).select("word").mapInArrow(count, TABLE_SCHEMA), ORDERS)


class Predictors:
    """Logits and count levels of all slots."""

    def __init__(self, tables: np.ndarray):
        zeros, ones = tables[..., 0], tables[..., 1]
        self.logits = np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)
        # The last two orders choose the gate: their levels are kept as digits of its number.
        digits = np.searchsorted(LEVEL_STARTS, zeros + ones, side="right")[-2:]
        self.gates = (digits * np.array([[LEVELS], [1]])).astype(np.int8)

    def look(self, slots: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        logits = [table.take(own) for table, own in zip(self.logits, slots, strict=True)]
        gates = self.gates[0].take(slots[-2])
        gates += self.gates[1].take(slots[-1])
        return logits, gates.astype(np.intp)


def _without_own(tables: np.ndarray) -> Predictors:
    """Predictors of 2 * slot + bit: of the slot as if that bit itself had not been counted."""
    left = np.maximum(tables[:, :, None, :] - np.eye(2, dtype=np.float32), 0.0)
    return Predictors(left.reshape(len(tables), -1, 2))


def start_weights() -> np.ndarray:
    return np.full((GATES, ORDERS), 0.4, dtype=np.float32)


def _weighed(weights: np.ndarray, gates: np.ndarray, logits: list[np.ndarray]) -> np.ndarray:
    """The mixture of the logits by the weights of the gates."""
    columns = np.ascontiguousarray(weights.T)
    total = columns[0].take(gates)
    total *= logits[0]
    for column, x in zip(columns[1:], logits[1:], strict=True):
        own = column.take(gates)
        own *= x
        total += own
    return total


def _outcome(mixed: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Negative log-probabilities of the bits, and by how much each bit exceeds its probability."""
    sign = bits.astype(np.float32)
    sign *= 2
    sign -= 1
    odds = mixed * sign
    np.clip(odds, -20.0, 20.0, out=odds)
    np.negative(odds, out=odds)
    np.exp(odds, out=odds)
    whole = 1 + odds
    odds /= whole
    sign *= odds
    return np.log(whole, out=whole), sign


def _fit(weights: np.ndarray, logits: list[np.ndarray], gates: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """One step of all sets along their mean gradient; returns how often each set was used."""
    _, error = _outcome(_weighed(weights, gates, logits), bits)
    seen = np.bincount(gates, minlength=GATES)
    for k, x in enumerate(logits):
        weights[:, k] += RATE * np.bincount(gates, weights=error * x, minlength=GATES) / (seen + 200.0)
    return seen


WEIGHT_SCHEMA = "weights array<double>, seen array<double>"


def _weight_rows(weights: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float64).ravel()]), pa.array([seen])], ["weights", "seen"])


def _averaged(fits: DataFrame) -> np.ndarray:
    """The weights of all tasks (GATES * ORDERS numbers each), averaged by how often each saw a gate."""
    rows = fits.collect()
    seen = np.asarray([r["seen"] for r in rows]).reshape(-1, GATES)
    weights = np.asarray([r["weights"] for r in rows]).reshape(-1, GATES, ORDERS)
    total = seen.sum(axis=0)[:, None]
    mean = (weights * seen[:, :, None]).sum(axis=0) / np.maximum(total, 1.0)
    return np.where(total > 0, mean, start_weights()).astype(np.float32)


def gate_weights(learned: DataFrame, code: Code, tables: np.ndarray) -> np.ndarray:
    """Weights that documents start with: each task fits the encoded documents it has, the driver averages."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, seen, left = start_weights(), np.zeros(GATES), _without_own(tables)
        for batch in batches:
            for plain, slots, bits in _coded(code, _symbols(batch.column(0))):
                slots *= 2
                slots += bits
                logits, gates = left.look(slots)
                seen += _fit(weights, [plain, *logits], gates, bits)
        yield _weight_rows(weights, seen)

    return _averaged(learned.select("ids").mapInArrow(fit, WEIGHT_SCHEMA))


def byte_weights(counts: DataFrame, tables: np.ndarray) -> np.ndarray:
    """Weights of spelled words, from all words, each once; they are not refined later."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, seen, left = start_weights(), np.zeros(GATES), _without_own(tables)
        for batch in batches:
            words = batch.column(0).to_pylist()
            for start in range(0, len(words), 500):
                slots, bits, _ = _byte_steps(words[start : start + 500])
                logits, gates = left.look(slots * 2 + bits)
                seen += _fit(weights, logits, gates, bits)
        yield _weight_rows(weights, seen)

    return _averaged(counts.filter(F.col("word") != END).select("word").mapInArrow(fit, WEIGHT_SCHEMA))


class Model:
    """What scoring needs: the code, both predictors with their weights, and the corpus totals."""

    def __init__(self, code: Code, token: Predictors, gates: np.ndarray, byte: Predictors, byte_gates: np.ndarray, total: int, distinct: int):
        self.code, self.token, self.gates, self.byte, self.byte_gates = code, token, gates, byte, byte_gates
        self.total, self.distinct = total, distinct

    def spelled(self, words: list[bytes], cache: dict[bytes, float]) -> dict[bytes, float]:
        """The log-probabilities of spelling the words; ``cache`` holds those of earlier ones."""
        wanted = dict.fromkeys(words)
        known = {w: cache[w] for w in wanted if w in cache}
        words = [w for w in wanted if w not in known]
        for start in range(0, len(words), 2048):
            part = words[start : start + 2048]
            slots, bits, sizes = _byte_steps(part)
            logits, gates = self.byte.look(slots)
            losses, _ = _outcome(_weighed(self.byte_gates, gates, logits), bits)
            known.update(zip(part, np.add.reduceat(-losses.astype(np.float64), np.cumsum(sizes) - sizes).tolist(), strict=True))
        if len(cache) + len(words) > SPELLED_CACHE:
            cache.clear()
        cache.update((w, known[w]) for w in words)
        return known

    def scores(self, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Log-probabilities of the documents' codes, block by block, all documents side by side."""
        contexts = _contexts(ids, begins)
        sizes = np.diff(np.append(begins, len(ids)))
        n_docs = len(sizes)
        document = np.repeat(np.arange(n_docs), sizes)
        block = (np.arange(len(ids)) - np.repeat(begins, sizes)) // BLOCK
        order = np.argsort(block, kind="stable")
        edges = np.searchsorted(block[order], np.arange(block.max() + 2))
        refined = np.zeros((ORDERS, n_docs), dtype=np.float32)
        out = np.zeros(n_docs)
        for start, stop in zip(edges, edges[1:], strict=False):
            at = order[start:stop]
            plain, slots, bits, lengths = _steps(self.code, ids[at], contexts[:, at])
            higher, gates = self.token.look(slots)
            logits = [plain, *higher]
            # A block is sorted by document: the documents it has, and where their bits begin.
            first = np.flatnonzero(np.diff(document[at], prepend=-1))
            own = document[at[first]]
            begin = (np.cumsum(lengths) - lengths)[first]
            n = np.diff(np.append(begin, len(bits)))
            mixed = _weighed(self.gates, gates, logits)
            for w, x in zip(refined, logits, strict=True):
                mixed += np.repeat(w[own], n) * x
            losses, error = _outcome(mixed, bits)
            out[own] -= np.add.reduceat(losses, begin, dtype=np.float64)
            for w, x in zip(refined, logits, strict=True):
                w[own] += REFINE * np.add.reduceat(error * x, begin) / (n + 64.0)
        return out


def word_code(counts: DataFrame) -> tuple[Code, int, int]:
    """The shared code of a corpus with these word counts, the number of its tokens and of its words."""
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    frequent = frequent_words(counts)
    code = Code(frequent, totals["total"] - sum(frequent.values()))
    code.share(counts.sparkSession)
    return code, totals["total"], totals["distinct"]


def train(documents: DataFrame, counts: DataFrame) -> Model:
    """A model of all training documents; ``counts`` are their word counts."""
    code, total, distinct = word_code(counts)
    return _trained(encoded(documents, code), counts, code, total, distinct)


def _trained(rows: DataFrame, counts: DataFrame, code: Code, total: int, distinct: int) -> Model:
    learned = rows.filter(~F.col("held_out"))
    tables = token_tables(learned, code)
    gates = gate_weights(learned, code, tables)
    spelling = byte_tables(counts)
    return Model(code, Predictors(tables), gates, Predictors(spelling), byte_weights(counts, spelling), total, distinct)


def mixed_scores(documents: DataFrame) -> DataFrame:
    """One row per document: n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Documents are learned from where crc32 of the id modulo 5 is not 1. NULL and empty texts are the
    end alone, with no bytes and NULL bits per byte. Rows that share an id are scored each on their own.
    """
    learned = documents.filter(remainder(F.col("doc_id"), DIVISOR) != HELD_OUT)
    counts = stored(word_counts(learned), "word-counts")
    code, total, distinct = word_code(counts)
    rows = encoded(documents, code)
    model = _trained(rows, counts, code, total, distinct)
    unit = model.total + 0.5 * (model.distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, float] = {}
        code, base = model.code, np.log10((model.code.counts + 0.5) / unit)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
                part = batch.slice(start, DOCUMENTS_AT_ONCE)
                ids = list(_symbols(part.column("ids")))
                rare = [dict(zip(w, n, strict=True)) for w, n in zip(part.column("rare").to_pylist(), part.column("times").to_pylist(), strict=True)]
                losses = model.spelled([w for c in rare for w in c], cache)
                sizes = np.asarray([len(i) for i in ids])
                flat, begins = np.concatenate(ids), np.cumsum(sizes) - sizes
                coded = model.scores(flat, begins)
                spelled = np.asarray([sum(losses[w] * n for w, n in c.items()) for c in rare])
                known = flat != code.index.escape
                columns = [
                    *(part.column(c) for c in names[:4]),
                    pa.array(sizes), pa.array(np.add.reduceat((known & (code.counts[flat] > 0)).astype(np.int64), begins)),
                    pa.array(np.add.reduceat(np.where(known, base[flat], 0.0), begins)), pa.array((coded + spelled) / LOG10), part.column("n_bytes"),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "held_out", "chunk", "nth", "n_tokens", "n_common", "base_common", "score", "n_bytes"]
    schema = "doc_id long, held_out boolean, chunk long, nth long, n_tokens long, n_common long, base_common double, score double, n_bytes long"
    scored = stored(rows.mapInArrow(score, schema), "scored")

    # Words outside the vocabulary get their exact counts from the table of all words.
    rare = rows.select("chunk", "nth", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("chunk", "nth", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    counted = rare.join(counts, "word", "left")
    n = F.coalesce("n", F.lit(0))
    added = counted.groupBy("chunk", "nth").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("n_rare"), F.sum(F.col("times") * F.log10((n + 0.5) / F.lit(float(unit)))).alias("base_rare")
    )
    full = scored.join(stored(added, "rare-words"), ["chunk", "nth"], "left")
    bits = -F.col("score") * float(np.log2(10.0))
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_common") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"), "score", F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )
