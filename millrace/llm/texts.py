"""Helpers that the text operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch, shared_dir, stored

__all__ = ["WORD", "WordHashes", "byte_alphabet", "let", "of_worker", "running", "scratch", "shared_dir", "stored", "table", "word_hashes", "words"]

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """All words of a text, in order; no words for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def byte_alphabet() -> list[str]:
    """The characters that byte-level vocabularies write for the 256 bytes.

    Printable Latin-1 stands for itself, the other bytes follow from character 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def of_worker(key: object, make: Callable[[], object]) -> object:
    """A value that is made once per Python worker: Spark reuses workers, so later tasks find it there.

    It lives in the interpreter and not in this module, which travels with each task anew. It may
    hold what a task has learned, but no result may depend on that.
    """
    held = sys.modules.setdefault("_of_this_worker", types.ModuleType("_of_this_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, of: str, block: int = 256) -> Column:
    """Running totals ("sum") or maxima ("max") of a non-empty array<bigint>.

    Two levels of ``block`` values each: an element is folded with its block and blocks with
    blocks, so the work per element stays bounded by ``block`` and not by the array's length.
    """
    low = F.lit(0 if of == "sum" else -(2**62)).cast("bigint")
    size = F.lit(block)

    def combine(a: Column, b: Column) -> Column:
        return a + b if of == "sum" else F.greatest(a, b)

    def folded(part: Column) -> Column:
        return F.aggregate(part, low, combine)

    def whole(v: Column) -> Column:
        block_of = lambda i: F.floor(i / size).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), block_of(F.size(v) - 1)), lambda b: folded(F.slice(v, b * size + 1, size)))
        before = let(blocks, lambda bs: F.transform(bs, lambda _, b: folded(F.slice(bs, F.lit(1), b))))

        def totals(known: Column) -> Column:
            return F.transform(
                v, lambda _, i: combine(F.get(known, block_of(i)), folded(F.slice(v, block_of(i) * size + 1, i % size + 1)))
            )

        return let(before, totals)

    return let(values, whole)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered for as many words as ``bound``."""

    def __init__(self, bound: int = 1_000_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case. bytes.split() splits at ASCII white space only."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
    return np.fromiter(map(cache.__getitem__, found), dtype=np.uint64, count=len(found))
