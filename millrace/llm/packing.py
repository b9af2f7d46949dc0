"""Best-fit packing of token sequences with a dominance reduction before it.

Whatever the corpus holds, at most ``capacity`` different piece lengths exist. So the packing is
planned on the table of lengths and counts: Martello and Toth's reduction fixes sets that provably
dominate every alternative, best fit in order of decreasing length packs the rest, and the plan is
a list of (pattern of lengths, number of sequences). Pieces then look up their place by length and
rank; the plan's size depends on ``capacity`` and not on the number of pieces.
"""

from __future__ import annotations

import base64
import bisect
import uuid
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.texts import stored

CAPACITY = 1024
END_ID = 2
# Encoded chunks that a worker remembers.
CACHE_CHUNKS = 300_000


class Encoder(dict):
    """Token ids of a text as little-endian unsigned 32-bit numbers, one after the other.

    The vocabulary's pattern never joins what a single space parts, except where the space touches
    other white space. Texts are therefore cut at single spaces and the ids of a chunk are
    remembered; texts with other white space around a space are encoded whole.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str, bound: int = CACHE_CHUNKS):
        import re

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.bound = bound
        self.reference = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.reference.get_added_tokens_decoder().values()]
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = re.compile(r" \s|\s ")

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        ids = self[chunk] = np.asarray(self.fast.encode_ordinary(chunk), dtype="<u4").tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.special):  # ids of special tokens are the tokenizer's business
            return np.asarray(self.reference.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if self.spaced.search(text):
            return np.asarray(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        return (self[first] if first else b"") + b"".join([self[" " + chunk] for chunk in rest])


def token_pieces(documents: DataFrame, tokenizer_file: str, ranks_file: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids per document: its text's ids, then the end id.

    Only longer documents are cut: all pieces but the first have ``capacity`` ids. NULL text counts
    as empty, which leaves the end id. ``chunk`` names the batch a piece came from and ``nth`` its
    number among the batch's pieces of its length; ``with_ids`` adds the ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_file, ranks_file)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            chunk, seen, columns = uuid.uuid4().hex, Counter(), defaultdict(list)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text or "") + end
                n = len(ids) // 4
                starts = [0, *range((n - 1) % capacity + 1, n, capacity)]
                for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    own = ids[4 * start : 4 * stop]
                    row = (doc_id, piece, start, stop - start, zlib.crc32(own), seen[stop - start])
                    seen[stop - start] += 1
                    for name, value in zip(("doc_id", "piece", "start", "length", "ids_crc32", "nth"), row, strict=True):
                        columns[name].append(value)
                    if with_ids:
                        columns["ids"].append(np.frombuffer(own, dtype="<u4").astype(np.int32))
            columns["chunk"] = [chunk] * len(columns["doc_id"])
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "nth": pa.int64(), "chunk": pa.string()}
    if with_ids:
        kinds["ids"] = pa.list_(pa.int32())
    arrow = pa.schema(list(kinds.items()))
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.list_(pa.int32()): "array<int>"}
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, ", ".join(f"{c} {names[t]}" for c, t in kinds.items()))


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Patterns that belong to some best packing, and the counts that remain.

    Lengths go from long to short. A set {j, ...} is fixed when it dominates every other set that
    holds j, that is, when the other items of any such set can be dealt to the set's own items
    without exceeding one of them:
    - j alone, where nothing else fits;
    - j and k, the longest that fits, where they fill the sequence, or where any two or more items
      that fit with j are together no longer than k;
    - j, a, b, where no three others fit and of any two that fit the shorter is at most b.
    What is removed only takes alternatives away, so a set is fixed as often as its items allow.
    """
    left = {length: n for length, n in counts.items() if n}
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(*pattern: int) -> None:
        need = Counter(pattern)
        times = min(left[length] // n for length, n in need.items())
        fixed.append((pattern, times))
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]

    def longest(at_most: int, without: Counter) -> int | None:
        return max((x for x in left if x <= at_most and left[x] > without[x]), default=None)

    def least_sum(n: int, without: Counter, above: int = 0) -> int | None:
        """Sum of the n shortest items over ``above``; None where there are not as many."""
        total = 0
        for x in sorted(x for x in left if x > above):
            take = min(n, left[x] - without[x])
            total, n = total + take * x, n - take
            if n == 0:
                return total
        return None

    def sums_beyond(k: int, room: int, without: Counter) -> bool:
        """Whether two or more items fit into ``room`` with a sum over k."""
        one, many, mask = 0, 0, (1 << (room + 1)) - 1
        for x in sorted(left):
            for _ in range(min(left[x] - without[x], room // x)):
                many |= (many << x | one << x) & mask
                if many >> (k + 1):
                    return True
                one |= 1 << x
        return False

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while j in left:
                own, room = Counter([j]), capacity - j
                k = longest(room, own)
                if k is None:
                    fix(j)
                elif k == room or not sums_beyond(k, room, own):
                    fix(j, k)
                else:
                    b = longest(room - k, own + Counter([k]))
                    three, two = least_sum(3, own), least_sum(2, own, above=b or 0)
                    if b is None or (three is not None and three <= room) or (two is not None and two <= room):
                        break
                    fix(j, k, b)
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in order of decreasing length, on groups of equal sequences.

    An item goes where it leaves least room. Of equal items the next goes to the same sequence
    while it fits, so a group takes as many per sequence as its room allows.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []  # sorted keys of open_ that hold groups

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if n:
            if not open_[room]:
                bisect.insort(rooms, room)
            open_[room].append((pattern, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, bins = open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
            else:
                room, pattern, bins = capacity, (), -(-n // (capacity // length))
            each = min(room // length, n)
            filled = min(bins, n // each)
            put(room - each * length, pattern + (length,) * each, filled)
            n -= each * filled
            if bins > filled and n:  # fewer items than one more sequence could take
                put(room - n * length, pattern + (length,) * n, 1)
                filled, n = filled + 1, 0
            if pattern or room < capacity:
                put(room, pattern, bins - filled)
    return [group for groups in open_.values() for group in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    fixed, left = reduced(counts, capacity)
    return fixed + best_fit(left, capacity)


def _runs(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first ranks of its runs, the sequence of each first rank, and the offset there."""
    ranks, rows, sequence = Counter(), defaultdict(list), 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows[length].append((ranks[length], sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    return {length: tuple(np.asarray(c, dtype=np.int64) for c in zip(*r, strict=True)) for length, r in rows.items()}


def packed(documents: DataFrame, tokenizer_file: str, ranks_file: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there; sequences have no gaps.

    Repeated rows and rows without doc_id are documents of their own. No documents, no rows.
    """
    pieces = stored(token_pieces(documents, tokenizer_file, ranks_file, capacity, with_ids), "pieces")
    # Ranks among all pieces of a length: the batches' counts, added up per length, then the number within the batch.
    counts = stored(pieces.groupBy("chunk", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs = _runs(plan(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select(F.col("chunk").alias("of_chunk"), F.col("length").alias("of_length"), F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(first, (F.col("chunk") == F.col("of_chunk")) & (F.col("length") == F.col("of_length")))
    kept = [c for c in pieces.columns if c not in ("chunk", "nth")]
    ranked = ranked.select(*kept, (F.col("before") + F.col("nth")).alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            place = np.empty((2, len(lengths)), dtype=np.int64)
            for length in np.unique(lengths):
                own = lengths == length
                starts, sequences, offsets = runs[int(length)]
                at = np.searchsorted(starts, ranks[own], side="right") - 1
                place[0, own] = sequences[at] + ranks[own] - starts[at]
                place[1, own] = offsets[at]
            columns = [batch.column(c) for c in kept] + [pa.array(place[0]), pa.array(place[1])]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank")
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long")
