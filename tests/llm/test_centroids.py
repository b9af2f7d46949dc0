"""Centroid clustering against its SQL twin and against a plain loop over integers."""

import hashlib
import math
import random

import numpy as np
import parity
import pytest
from conftest import SF_DIR

from millrace.llm import centroids
from millrace.llm.oracle import CENTROID_CLUSTERS
from millrace.llm.queries import op11_centroid_clusters

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, distance string, centroid int, ids int"


def brute(rows, k, rounds, dimensions=4, seed=2):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    keyed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centers = [v for _, v in keyed[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = [[] for _ in centers]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else c for m, c in zip(members, centers, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    total = sum(d for _, _, d in found)
    return sorted(((i, c, d, sum(e for _, o, e in found if o == c), total, hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()) for i, c, d in found), key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3, 4) for i, v in rows], SCHEMA)


def test_query_equals_its_twin(spark):
    assert parity.spark_rows(op11_centroid_clusters(spark, SF_DIR)) == parity.sql_rows(parity.connect(SF_DIR), CENTROID_CLUSTERS)


def test_awkward_rows_against_a_plain_loop(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((-0.5, -0.01, 0.0, 0.25, 1.5)) for _ in range(4)]) for i in range(300)]
    rows += [(7, [0.25] * 4)] * 50 + [(None, [1.0] * 4), (None, [9.0, -9.0, 0.0, 0.0])]
    rows += [(901, None), (902, []), (903, [1.0] * 3), (904, [1.0, None, 1.0, 1.0]), (905, [1.0, math.nan, 1.0, 1.0]), (906, [1.0, math.inf, 1.0, 1.0]), (907, [1.0] * 5)]
    for k, rounds in ((6, 5), (1, 2), (40, 3)):
        got = centroids.with_digests(centroids.clustered(frame(spark, rows).repartition(7), k, rounds, dimensions=4))
        assert rows_of(got) == brute(rows, k, rounds)


def test_fewer_vectors_than_centroids_and_equal_ones(spark):
    rows = [(1, [0.5] * 4), (2, [0.5] * 4), (3, [-0.5] * 4)]
    assert rows_of(centroids.with_digests(centroids.clustered(frame(spark, rows), 40, 5, dimensions=4))) == brute(rows, 40, 5)


def test_no_vectors_no_rows(spark):
    got = centroids.with_digests(centroids.clustered(frame(spark, [(1, None), (2, [1.0])]), dimensions=4))
    assert got.collect() == []
    assert centroids.clustered(frame(spark, []), dimensions=4).count() == 0


def test_numbers_too_large_for_exact_distances_raise(spark):
    with pytest.raises(Exception, match="distances are exact below"):
        centroids.clustered(frame(spark, [(1, [1e9, 0.0, 0.0, 0.0])]), dimensions=4).collect()


@pytest.mark.parametrize("distinct", [1, 3, 500])
def test_blocks_lose_nothing_and_distances_are_exact(distinct):
    rng = np.random.default_rng(distinct)
    vectors = rng.integers(-(2**26), 2**26, (distinct, 16))[rng.integers(0, distinct, 1000)]
    found = centroids.blocks(vectors)
    back = np.hstack([entries[codes] for _, entries, codes in found])
    assert (back == vectors).all()
    centers = vectors[:5]
    wanted = ((vectors[:, None, :] - centers[None]).astype(object) ** 2).sum(axis=2)
    cluster, distance = centroids.nearest(found, centers)
    assert (distance == wanted.min(axis=1)).all() and (cluster == np.argmin(wanted, axis=1)).all()
    sums = centroids.cluster_sums(found, cluster, 5, 16)
    assert (sums[:, :16] == [vectors[cluster == c].sum(axis=0) for c in range(5)]).all()


def test_repeated_vectors_share_one_entry():
    found = centroids.blocks(np.tile(np.arange(64), (1000, 1)))
    assert [(start, entries.shape) for start, entries, _ in found] == [(0, (1, 64))]
