"""Bounded training samples of labelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, rows: int, columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """``columns`` of at most ``rows`` labelled documents outside the held-out remainder, label and fold (0 or 1).

    The sample is drawn from the labels by hash of the id, so it is the same in every run. Its ids
    are what is broadcast, 16 bytes each. NULL labels and ids are left out, and of an id that is
    labelled twice the larger label counts.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder(F.col("doc_id"), divisor) != held_out))
    usable = usable.groupBy(F.col("doc_id").alias("sampled_id")).agg(F.max(F.col(label)).cast("int").alias("label"))
    drawn = usable.orderBy(F.xxhash64("sampled_id"), "sampled_id").limit(rows)
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(2)).cast("int")
    joined = documents.select("doc_id", *columns).join(F.broadcast(drawn), F.col("doc_id") == F.col("sampled_id"))
    return joined.select(*columns, "label", fold.alias("fold"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 0.3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression (the intercept comes last and is not penalised), by Newton's method."""
    x = np.hstack([features, np.ones((len(features), 1))])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (p - labels) + ridge @ w)
        w -= np.clip(step, -5.0, 5.0)
    return w
