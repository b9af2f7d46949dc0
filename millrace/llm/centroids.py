"""Exact centroid clustering over subvector dictionaries.

Vectors are integers, so every distance and mean is exact and no result depends on how the rows are
dealt out. Each chunk of rows is stored as blocks of dimensions: a block has the distinct subvectors
of the chunk and one code per row, and nothing is lost. A round computes the distances of the
distinct subvectors to the centroids, sums them by code for every row, and adds up the members of a
cluster by counting codes. Rows never move: a round shuffles one sum per task, centroid and
dimension, and the driver holds the centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.texts import stored

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
# Integers below this have distances that 64 bits hold.
LARGEST = 1 << 27
# A block is halved while it has more distinct subvectors than this share of its rows.
DISTINCT_SHARE = 0.25
# Rows of one chunk; its dictionaries and its table of distances follow this.
CHUNK_ROWS = 8192

CHUNK_SCHEMA = "ids array<long>, starts array<int>, dictionaries array<array<int>>, codes array<binary>"
CHUNK_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("dictionaries", pa.list_(pa.list_(pa.int32()))), ("codes", pa.list_(pa.binary()))])
SUM_SCHEMA = "cluster int, dimension int, total long"

Block = tuple[int, np.ndarray, np.ndarray]


def usable(embedding: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether a vector has the right number of components, none of them NULL, NaN or infinite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(embedding) == dimensions) & finite, F.lit(False))


def integers(flat: np.ndarray, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the components, one row per vector; raises where distances could exceed 64 bits."""
    whole = np.floor(flat.astype(np.float64) * scale)
    if len(whole) and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component is {np.abs(whole).max():g} after scaling; distances are exact below {LARGEST}")
    return whole.astype(np.int64).reshape(-1, dimensions)


def _code_type(distinct: int) -> np.dtype:
    return np.dtype("<u1") if distinct <= 1 << 8 else np.dtype("<u2") if distinct <= 1 << 16 else np.dtype("<u4")


def _distinct(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and per row the number of its own."""
    rows = np.ascontiguousarray(part)
    _, first, codes = np.unique(rows.view([("", rows.dtype)] * rows.shape[1]).ravel(), return_index=True, return_inverse=True)
    return rows[first], codes


def blocks(vectors: np.ndarray) -> list[Block]:
    """First dimension, distinct subvectors and codes of each block.

    A block starts as all dimensions, so repeated vectors share one entry, and is halved while most
    of its subvectors are distinct.
    """
    out: list[Block] = []

    def split(start: int, stop: int) -> None:
        entries, codes = _distinct(vectors[:, start:stop])
        if stop - start > 1 and len(entries) > DISTINCT_SHARE * len(vectors):
            middle = (start + stop) // 2
            split(start, middle)
            split(middle, stop)
        else:
            out.append((start, entries, codes))

    split(0, vectors.shape[1])
    return out


def chunk_row(ids: list, vectors: np.ndarray) -> pa.RecordBatch:
    found = blocks(vectors)
    row = {
        "ids": ids,
        "starts": [start for start, _, _ in found],
        "dictionaries": [entries.astype(np.int32).ravel() for _, entries, _ in found],
        "codes": [codes.astype(_code_type(len(entries))).tobytes() for _, entries, codes in found],
    }
    return pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)


def encoded(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Chunks of the vectors (vec_id, embedding) in dictionary form."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(start, CHUNK_ROWS)
                yield chunk_row(part.column(0).to_pylist(), integers(part.column(1).flatten().to_numpy(), dimensions, scale))

    return vectors.select("vec_id", "embedding").mapInArrow(chunks, CHUNK_SCHEMA)


def _decoded(batch: pa.RecordBatch, row: int, dimensions: int) -> tuple[list, list[Block]]:
    ids, starts, dictionaries, codes = (batch.column(c)[row].as_py() for c in range(4))
    out = []
    for start, stop, entries, packed in zip(starts, [*starts[1:], dimensions], dictionaries, codes, strict=True):
        own = np.asarray(entries, dtype=np.int64).reshape(-1, stop - start)
        out.append((start, own, np.frombuffer(packed, dtype=_code_type(len(own)))))
    return ids, out


def nearest(found: list[Block], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance per row; of equal distances the centroid with the smaller number."""
    total: np.ndarray | int = 0
    for start, entries, codes in found:
        away = entries[:, None, :] - centroids[None, :, start : start + entries.shape[1]]
        total = total + np.einsum("ekd,ekd->ek", away, away)[codes]
    best = np.argmin(total, axis=1)
    return best, total[np.arange(len(best)), best]


def cluster_sums(found: list[Block], clusters: np.ndarray, k: int, dimensions: int) -> np.ndarray:
    """Per cluster the componentwise sums, and in the last column the number of rows."""
    out = np.zeros((k, dimensions + 1), dtype=np.int64)
    out[:, dimensions] = np.bincount(clusters, minlength=k)
    for start, entries, codes in found:
        n = np.bincount(clusters * len(entries) + codes, minlength=k * len(entries)).reshape(k, len(entries))
        out[:, start : start + entries.shape[1]] += n @ entries
    return out


def first_centroids(vectors: DataFrame, dimensions: int, scale: int, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in that order; of equal ids the smaller components.

    Rows without an id have no hash and come last.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    return integers(np.asarray([r["embedding"] for r in rows], dtype=np.float64).ravel(), dimensions, scale)


def moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means; one without members stays."""
    k, dimensions = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimensions + 1), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                _, found = _decoded(batch, row, dimensions)
                total += cluster_sums(found, nearest(found, centroids)[0], k, dimensions)
        cluster, dimension = np.nonzero(total)
        columns = [pa.array(cluster, pa.int32()), pa.array(dimension, pa.int32()), pa.array(total[cluster, dimension])]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "dimension", "total"])

    new = np.zeros((k, dimensions + 1), dtype=object)
    for row in chunks.mapInArrow(sums, SUM_SCHEMA).groupBy("cluster", "dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        new[row["cluster"], row["dimension"]] = int(row["total"])
    means = [[x // r[-1] for x in r[:-1]] if r[-1] else old for r, old in zip(new.tolist(), centroids.tolist(), strict=True)]
    return np.asarray(means, dtype=np.int64).reshape(k, dimensions)


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every row."""
    dimensions = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, found = _decoded(batch, row, dimensions)
                cluster, distance = nearest(found, centroids)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return chunks.mapInArrow(assign, "vec_id long, cluster int, distance long")


def clustered(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (its components).

    Vectors of another length, NULL ones and those with a NULL, NaN or infinite component are left
    out; no usable vector, no rows. Repeated rows, and rows that share an id or have none, are vectors
    of their own. With fewer vectors than ``k`` each is a centroid; equal centroids leave all but the
    first empty. A component of LARGEST or more after scaling raises, as distances would not fit.
    """
    spark = embeddings.sparkSession
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(usable(F.col("embedding"), dimensions))
    centroids = first_centroids(kept, dimensions, scale, k, seed)
    chunks = stored(encoded(kept, dimensions, scale), "vector-chunks")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(chunks, centroids)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    rows = stored(assigned(chunks, centroids), "assigned-vectors")
    # At most k rows: what is said of whole clusters, joined back to their members.
    sums = {r["cluster"]: r["total"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    about = [(c, sums[c], sum(sums.values()), centroids[c].tolist()) for c in sorted(sums)]
    schema = T.StructType([T.StructField("of_cluster", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("cluster_inertia", "inertia")], T.StructField("centroid", T.ArrayType(T.LongType()))])
    joined = rows.join(F.broadcast(spark.createDataFrame(about, schema)), F.col("cluster") == F.col("of_cluster"))
    return joined.drop("of_cluster")


def with_digests(clusters: DataFrame) -> DataFrame:
    """The clusters with the SHA-256 of their centroid's components, joined by commas, in place of these."""
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return clusters.withColumn("centroid_sha256", F.sha2(text, 256)).drop("centroid")


def digest(components: list[int]) -> str:
    """The digest of one centroid, as ``with_digests`` has it."""
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()
