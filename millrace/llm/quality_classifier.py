"""Document quality by a factorisation machine.

Features are hashed words, statistics of the text's structure and metadata. Every pair of features
interacts through low-rank factors, and the sum over all pairs is linear in their number:
0.5 * ((sum of v x)^2 - sum of (v x)^2), per factor.

The model has a fixed size, whatever it is trained on, and is broadcast; training takes a bounded
sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.labelled import labelled_sample, remainder, sigmoid

WORD_BUCKETS = 1 << 16
BINS = 16
# Statistics by position; each is cut into BINS and every bin is a feature of its own.
STATISTICS = (
    "words", "word_length", "upper", "digits", "marks", "exclamations", "other_bytes", "punctuation", "lines",
    "distinct_words", "same_lines", "same_sentences", "chars",
)
# Weights of both kinds of features. Structure generalises from fewer rows than words do.
WORDS, STATISTIC = 0.3, 0.8
FACTORS = 8
SAMPLE_ROWS = 12_000
EPOCHS, BATCH, RATE, DECAY = 8, 256, 0.08, 2e-5
# Small samples are gone through more often, in smaller batches, for as many steps as this.
MIN_STEPS = 600
CACHE_WORDS = 500_000
DIVISOR, HELD_OUT, THRESHOLD = 5, 0, 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = b"#*$%&|<>"
_PUNCTUATION = b".,;:"
_ASCII = bytes(range(128))
SIZE = WORD_BUCKETS + BINS * len(STATISTICS)


class Buckets(dict):
    """Buckets of words, remembered for up to ``bound`` words."""

    def __init__(self, bound: int = CACHE_WORDS):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) % WORD_BUCKETS
        return value


def _count(data: bytes, kind: bytes) -> int:
    return len(data) - len(data.translate(None, kind))


def _share(part: float, whole: float) -> float:
    """A share with its small values spread."""
    return (part / whole) ** 0.5 if whole else 0.0


def features(text: str | None, n_chars: int | None, buckets: Buckets) -> np.ndarray:
    """Distinct features of a text: buckets of its words, then one bin per statistic.

    ``n_chars`` is the only metadata; without it the length of the text stands in.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    distinct = set(words)
    size, inked = len(data), sum(map(len, words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    sentences = [s for s in data.split(b". ") if len(s) > 20]
    chars = len(text or "") if n_chars is None or n_chars < 0 else n_chars
    shares = (
        np.log2(1 + len(words)) / 16, inked / (20 * len(words)) if words else 0.0, _share(_count(data, _UPPER), _count(data, _UPPER + _LOWER)),
        _share(_count(data, _DIGITS), inked), _share(_count(data, _MARKS), inked), _share(data.count(b"!"), inked),
        _share(size - _count(data, _ASCII), size), _share(_count(data, _PUNCTUATION), inked), _share(len(lines), len(words)),
        _share(len(distinct), len(words)), _share(len(lines) - len(set(lines)), len(lines)),
        _share(len(sentences) - len(set(sentences)), len(sentences)), np.log2(1 + chars) / 24,
    )
    bins = [WORD_BUCKETS + k * BINS + min(int(s * BINS), BINS - 1) for k, s in enumerate(shares)]
    hashed = np.unique(np.fromiter(map(buckets.__getitem__, distinct), dtype=np.int32, count=len(distinct)))
    return np.concatenate([hashed, np.asarray(bins, dtype=np.int32)])


def _values(index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Words of a text share a length of WORDS; each statistic counts STATISTIC."""
    is_word = index < WORD_BUCKETS
    n_words = np.add.reduceat(is_word.astype(np.float32), rows)
    counts = np.diff(np.append(rows, len(index)))
    return np.where(is_word, np.repeat(WORDS / np.sqrt(np.maximum(n_words, 1.0)), counts), STATISTIC).astype(np.float32)


class FactorisationMachine:
    """bias + sum of w x + sum over pairs of <v_i, v_j> x_i x_j."""

    def __init__(self, size: int = SIZE, factors: int = FACTORS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.w = np.zeros(size, dtype=np.float32)
        self.v = rng.normal(0, 0.05, (size, factors)).astype(np.float32)

    def raw(self, index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the sigmoid of the texts whose features start at ``rows``, with what a gradient needs."""
        x = _values(index, rows)
        vx = self.v[index] * x[:, None]
        sums = np.add.reduceat(vx, rows)
        pairs = 0.5 * (sums**2 - np.add.reduceat(vx**2, rows)).sum(axis=1)
        return self.bias + np.add.reduceat(self.w[index] * x, rows) + pairs, x, sums

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> FactorisationMachine:
        """Adagrad on the logistic loss, in batches."""
        rng = np.random.default_rng(seed)
        if len(texts):
            share = np.clip(labels.mean(), 0.02, 0.98)
            self.bias = float(np.log(share / (1 - share)))
        seen_w, seen_v, seen_bias = np.full(len(self.w), 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32), 1e-6
        size = min(BATCH, max(16, len(texts) // 16))
        epochs = max(epochs, -(-MIN_STEPS * size // max(len(texts), 1)))
        for _ in range(epochs if len(texts) else 0):
            order = rng.permutation(len(texts))
            for start in range(0, len(order), size):
                batch = [texts[i] for i in order[start : start + size]]
                counts = np.asarray([len(t) for t in batch])
                rows, index = np.concatenate([[0], np.cumsum(counts)[:-1]]), np.concatenate(batch)
                raw, x, sums = self.raw(index, rows)
                error = ((sigmoid(raw) - labels[order[start : start + size]]) / len(batch)).astype(np.float32)
                per = np.repeat(error, counts) * x
                own, where = np.unique(index, return_inverse=True)
                gw = np.bincount(where, weights=per, minlength=len(own)).astype(np.float32) + DECAY * self.w[own]
                moved = per[:, None] * (np.repeat(sums, counts, axis=0) - self.v[index] * x[:, None])
                gv = np.stack([np.bincount(where, weights=moved[:, f], minlength=len(own)) for f in range(moved.shape[1])], axis=1)
                gv = gv.astype(np.float32) + DECAY * self.v[own]
                seen_w[own] += gw**2
                seen_v[own] += gv**2
                self.w[own] -= RATE * gw / np.sqrt(seen_w[own])
                self.v[own] -= RATE * 0.25 * gv / np.sqrt(seen_v[own])
                seen_bias += float(error.sum()) ** 2
                self.bias -= RATE * float(error.sum()) / seen_bias**0.5
        return self


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """A machine trained on at most ``rows`` labelled documents outside the held-out remainder.

    Features are made by the executors; the driver gets the sample's feature numbers, of which a
    document has at most SIZE. Without a labelled document every score is near 0.5.
    """
    columns = ("text", "n_chars") if "n_chars" in documents.columns else ("text",)
    sample = labelled_sample(documents, labels, "quality", DIVISOR, HELD_OUT, rows, columns)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            texts, chars = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [features(t, n, buckets).tobytes() for t, n in zip(texts, chars, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(2)], ["features", "label"])

    chars = F.col("n_chars").cast("long") if len(columns) == 2 else F.lit(None).cast("long")
    got = sample.select("text", chars, "label").mapInArrow(extract, "features binary, label int").toArrow()
    rows_ = sorted(zip(got.column("features").to_pylist(), got.column("label").to_pylist(), strict=True))  # one order in every run
    texts = [np.frombuffer(f, dtype=np.int32) for f, _ in rows_]
    return FactorisationMachine().fit(texts, np.asarray([y for _, y in rows_], dtype=np.float32))


def quality_score(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Column:
    """A column for ``documents``: score from 0 to 1, higher where label 1 is likelier.

    NULL and empty texts are scored by their statistics. Rows are scored each on their own.
    """
    machine = train(documents, labels, rows)
    model = documents.sparkSession.sparkContext.broadcast((machine.bias, machine.w, machine.v))  # SIZE * (FACTORS + 1) numbers

    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        machine = FactorisationMachine(1, 1)
        machine.bias, machine.w, machine.v = model.value
        buckets = Buckets()
        for texts, chars in batches:
            scores = np.empty(len(texts))
            for start in range(0, len(texts), BATCH):
                part = slice(start, start + BATCH)
                found = [features(t, n, buckets) for t, n in zip(texts.iloc[part], chars.iloc[part], strict=True)]
                begins = np.cumsum([0, *map(len, found[:-1])])
                scores[part] = sigmoid(machine.raw(np.concatenate(found), begins)[0])
            yield pd.Series(scores)

    chars = F.coalesce(F.col("n_chars").cast("long"), F.lit(-1)) if "n_chars" in documents.columns else F.lit(-1).cast("long")
    return F.pandas_udf(score, "double")(F.col("text"), chars)


def judged(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    held_out = remainder(F.col("doc_id"), DIVISOR) == HELD_OUT
    scored = documents.select("doc_id", held_out.alias("held_out"), quality_score(documents, labels, rows).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def kept(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, all columns as they were."""
    return documents.filter(quality_score(documents, labels, rows) >= threshold)
