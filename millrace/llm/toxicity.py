"""Toxicity by two class-conditional Kneser-Ney models.

Each class (toxic, ordinary) has a model of expressions in three orders: a word, words that begin
like it, and anything. Counts are discounted by an absolute amount, in proportion to the size of
the class, and the discounted mass goes to the next order. As in Kneser-Ney smoothing the lower
orders are made of the discounted mass itself, and they are shared by both classes: an expression
too rare to tell the classes apart gets the same backoff from both and moves nothing.

A document is compared by its length-normalised log-likelihoods, and by what single words have beyond
a level: that of the ordinary class's median word, or that of the document's own where it is lower, as
a language or a topic can shift all words alike. Where most words are toxic, all of them are evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.labelled import labelled_sample, logistic, remainder, sigmoid

EXPRESSION = re.compile(r"[^\W\d_]+")
PREFIX = 4
# Discount of the smaller class; the larger one's is as many times that as it has more words.
DISCOUNT = 2.0
# Log ratios count as evidence from this far above the level.
MARGIN = 2.0
SAMPLE_ROWS = 20_000
CACHE_WORDS = 500_000
DIVISOR, HELD_OUT, THRESHOLD = 4, 2, 0.3


def _key(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1


def expression_counts(sample: DataFrame) -> DataFrame:
    """Counts of each word by fold and label: fold, label, word and prefix (hashes), n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, int], Counter] = {}
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen.setdefault((fold, label), Counter()).update(EXPRESSION.findall((text or "").lower()))
            rows = [(f, y, _key(w), _key(w[:PREFIX]), n) for (f, y), counts in seen.items() for w, n in counts.items()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["fold", "label", "word", "prefix", "n"])

    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    rows = sample.select("text", "label", "fold").mapInArrow(count, "fold int, label int, word long, prefix long, n long")
    return rows.groupBy("fold", "label", "word", "prefix").agg(F.sum("n").alias("n"))


class Ratios:
    """Log ratio toxic : ordinary of every word, from the counts of both classes."""

    def __init__(self, label: np.ndarray, word: np.ndarray, prefix: np.ndarray, n: np.ndarray, discount: float = DISCOUNT):
        words, at, where = np.unique(word, return_index=True, return_inverse=True)
        groups, group = np.unique(prefix[at], return_inverse=True)
        counts = np.stack([np.bincount(where, weights=np.where(label == c, n, 0), minlength=len(words)) for c in (0, 1)])
        sizes = np.maximum(counts.sum(axis=1), 1.0)
        amounts = (discount * sizes / sizes.min())[:, None]
        # Order by order: what stays above the discount, what was taken, and what both classes share.
        taken = np.minimum(counts, amounts)
        by_group = np.stack([np.bincount(group, weights=taken[c], minlength=len(groups)) for c in (0, 1)])
        group_taken = np.minimum(by_group, amounts)
        total_taken = np.maximum(group_taken.sum(axis=1, keepdims=True), 1e-9)
        group_share = group_taken.sum(axis=0) / max(group_taken.sum(), 1e-9)
        mass = np.maximum(by_group - amounts, 0) + total_taken * group_share
        share = taken.sum(axis=0) / np.maximum(by_group.sum(axis=0)[group], 1e-9)
        own = np.maximum(counts - amounts, 0) + mass[:, group] * share
        telling = (counts > amounts).any(axis=0)
        self.words, self.word_ratio = words[telling], self._ratio(own[:, telling], sizes)
        self.groups, self.group_ratio = groups, self._ratio(mass, sizes)
        self.other = float(self._ratio(total_taken, sizes)[0])
        # The ordinary class's median word.
        ratios, seen = np.where(telling, self._ratio(own, sizes), self.group_ratio[group]), counts[0]
        order = np.argsort(ratios)
        self.level = float(ratios[order[np.searchsorted(np.cumsum(seen[order]), seen.sum() / 2)]]) if seen.any() else 0.0

    @staticmethod
    def _ratio(mass: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        mass = np.maximum(mass, 1e-9)
        return np.log(mass[1] / sizes[1]) - np.log(mass[0] / sizes[0])

    def of(self, word: str) -> float:
        for key, keys, ratios in ((_key(word), self.words, self.word_ratio), (_key(word[:PREFIX]), self.groups, self.group_ratio)):
            at = int(np.searchsorted(keys, key))
            if at < len(keys) and keys[at] == key:
                return float(ratios[at])
        return self.other


class Evidence(dict):
    """What the calibration looks at; remembers ratios of up to ``bound`` words."""

    def __init__(self, ratios: Ratios, bound: int = CACHE_WORDS):
        super().__init__()
        self.ratios, self.bound = ratios, bound

    def __missing__(self, word: str) -> float:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = self.ratios.of(word)
        return value

    def of(self, text: str | None) -> tuple[float, float, float, float]:
        """Normalised evidence, its sum, the normalised log ratio above the ordinary level, and that ratio; zeros without words."""
        found = EXPRESSION.findall((text or "").lower())
        if not found:
            return 0.0, 0.0, 0.0, 0.0
        ratios = np.fromiter(map(self.__getitem__, found), dtype=np.float64, count=len(found))
        level = self.ratios.level
        beyond = np.maximum(ratios - min(float(np.median(ratios)), level) - MARGIN, 0.0)
        return float(beyond.mean()), float(beyond.sum()), float(ratios.mean()) - level, float(ratios.mean())


def _features(evidence: np.ndarray) -> np.ndarray:
    return np.stack([np.log1p(50.0 * evidence[:, 0]), np.log1p(evidence[:, 1]), evidence[:, 2]], axis=1)


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[Ratios, np.ndarray]:
    """Ratios from the whole sample, and the calibration from ratios of the other half of the sample.

    The driver gets the counts of the sample's words and three numbers per sampled document; the
    sample has at most ``rows`` documents. Without a labelled document all scores are 0.5.
    """
    sample = labelled_sample(documents, labels, "toxic", DIVISOR, HELD_OUT, rows)
    counts = expression_counts(sample).toArrow()
    fold, label, word, prefix, n = (counts.column(c).to_numpy() for c in ("fold", "label", "word", "prefix", "n"))
    halves = [Ratios(*(c[fold != half] for c in (label, word, prefix, n))) for half in (0, 1)]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = [Evidence(r) for r in halves]
        for batch in batches:
            texts, y, folds = (c.to_pylist() for c in batch.columns)
            seen = np.asarray([evidence[f].of(t) for t, f in zip(texts, folds, strict=True)]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), *[pa.array(seen[:, k]) for k in range(3)]], ["label", "a", "b", "c"])

    looked = sample.select("text", "label", "fold").mapInArrow(look, "label int, a double, b double, c double").toArrow()
    seen = np.stack([looked.column(c).to_numpy() for c in ("a", "b", "c")], axis=1)
    return Ratios(label, word, prefix, n), logistic(_features(seen), looked.column("label").to_numpy())


def toxicity(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Score of every document and whether it reaches ``threshold``.

    Labels are used where crc32 of the id modulo 4 is not 2. NULL and empty texts have no evidence
    and get the score of none. Rows are scored each on their own, repeated ones alike.
    """
    ratios, weights = train(documents, labels, rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(ratios)
        for batch in batches:
            seen = np.asarray([evidence.of(t) for t in batch.column(2).to_pylist()]).reshape(-1, 4)
            scores = sigmoid(_features(seen) @ weights[:-1] + weights[-1])
            columns = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(seen[:, 3])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "log_ratio"])

    rows_ = documents.select(F.col("doc_id").cast("long"), (remainder(F.col("doc_id"), DIVISOR) == HELD_OUT).alias("held_out"), F.col("text"))
    return rows_.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, log_ratio double")
