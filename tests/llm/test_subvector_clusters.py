"""Clustering beside plain rounds, and its edges."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import subvector_clusters


def plain_clusters(vectors, k, rounds, dims):
    """(id, cluster, distance) in the order of the vectors, one vector and centroid at a time."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    by_hash = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in by_hash[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        where = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), w in zip(kept, where, strict=True) if w == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def frame(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("taken") for c in ("id", "v", "cluster", "distance")})


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(3)
    odd = [(900, None), (901, []), (902, [0.1] * 5), (903, [0.1, None, 0.2, 0.1, 0.1, 0.3]), (904, [float("nan")] * 6),
           (905, [float("inf")] * 6), (None, [0.3] * 6), (None, [0.2] * 6), (7, [0.5] * 6), (7, [0.5] * 6), (7, [-0.5] * 6)]
    return [(i, [rng.gauss(0, 0.4) for _ in range(6)]) for i in range(300)] + odd + [(1000 + i, [0.25] * 6) for i in range(150)]


@pytest.mark.parametrize(("width", "chunk"), [(1, 64), (2, 50), (4, 16_384), (6, 7)])
def test_clusters_equal_plain_rounds(spark, vectors, width, chunk):
    found, centroids = subvector_clusters.cluster_vectors(frame(spark, vectors), k=9, rounds=5, dims=6, width=width, chunk=chunk)
    want, plain = plain_clusters(vectors, 9, 5, 6)
    assert centroids.tolist() == plain
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_few_vectors_empty_tables_and_large_components(spark, vectors):
    few = vectors[:3]
    found, centroids = subvector_clusters.cluster_vectors(frame(spark, few), k=9, dims=6)
    assert len(centroids) == 3 and sorted(r.distance for r in found.collect()) == [0, 0, 0]
    found, centroids = subvector_clusters.cluster_vectors(frame(spark, few).filter("false"), k=9, dims=6)
    assert len(centroids) == 0 and found.count() == 0
    with pytest.raises(Exception, match="beyond 2\\^26"):
        subvector_clusters.cluster_vectors(frame(spark, [(1, [1e9] * 6)]), dims=6)


def test_an_empty_cluster_keeps_its_centroid(spark):
    same = [(i, [0.5, 0.5]) for i in range(4)] + [(9, [2.0, 2.0])]
    found, centroids = subvector_clusters.cluster_vectors(frame(spark, same), k=5, dims=2)
    want, plain = plain_clusters(same, 5, 5, 2)
    assert centroids.tolist() == plain and sorted(map(tuple, found.collect())) == sorted(want)


def test_a_dictionary_holds_each_subvector_once(spark):
    rows = frame(spark, [(i, [0.25, 0.5, float(i % 3), 1.0]) for i in range(90)])
    chunks = subvector_clusters.encoded(subvector_clusters.integer_vectors(rows, "vec_id", "embedding", 4, 256), 4, 2, 1000)
    for row in chunks.collect():
        part = subvector_clusters.Chunk(row.asDict(), 4, 2, 1000)
        assert part.sizes[0] == 1 and part.sizes[1] <= 3 and len(part.ids) <= 1000
        back = np.concatenate([found[code] for (_, found), code in zip(part.blocks, part.codes, strict=True)], axis=1)
        assert back.tolist() == [[64, 128, 256 * (i % 3), 256] for i in part.ids]
