"""Exact integer k-means (Lloyd's rounds) over subvector dictionaries.

Vectors become integers, floor(scale * x). Dimensions are cut into blocks of ``width``; the vectors of a
chunk are dictionary-encoded once, without loss: per block the distinct subvectors and, per vector, their codes. The
chunks are staged, and every round reads them alone:

1. per chunk and block the squared distance of every distinct subvector to every centroid's block is computed once;
2. a vector's distance to a centroid is the sum of its codes' partial distances, its cluster the least of them
   (ties: the smaller number);
3. a cluster's sums come from the dictionaries as well: how often each code fell in it, times the subvector.

Tasks send (cluster, dimension, count, sum) for their part, Spark adds them up, and k * dims sums come to the
driver, which floors the quotients and ships k centroids for the next round. Chunks hold CHUNK vectors at most whatever the
table's size, so equal vectors, however many, only make a dictionary smaller; nothing is shuffled but the sums.

Edge cases: vectors that are null, of another length than ``dims`` or that hold null or non-finite components
take no part; rows that repeat an id are vectors of their own; a null id starts no centroid before any other does; equal hashes (of
repeated ids) start in the order of their components; fewer vectors than k give fewer centroids; an empty cluster keeps its
centroid; an empty table has no rows; further columns are not read. Components beyond 2^26 after scaling raise an
error, as their distances would not fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.frames import stage

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
#: Dimensions in a block, and vectors in a chunk.
WIDTH, CHUNK = 2, 16_384
#: Vectors whose distances are held at once.
_AT_ONCE = 4_096
_LARGEST = 1 << 26


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the usable vectors."""
    double = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = (F.size(vector) == dims) & F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("id"), F.transform(double, lambda x: F.floor(x * scale).cast("long")).alias("v"))


def encoded(vectors: DataFrame, dims: int, width: int, chunk: int) -> DataFrame:
    """(ids, codes, sizes, entries) of each chunk: codes block after block, the dictionaries of all blocks end to end."""
    starts = list(range(0, dims, width))

    def encode(ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        if np.abs(v).max() > _LARGEST:
            raise ValueError("a scaled component is beyond 2^26")
        codes, sizes, entries = [], [], []
        for s in starts:
            block = np.ascontiguousarray(v[:, s:s + width].astype(np.int32))
            found, code = np.unique(block, axis=0, return_inverse=True)
            codes.append(code.ravel().astype(np.uint16 if chunk <= 1 << 16 else np.uint32))
            sizes.append(len(found))
            entries.append(found.astype(np.int32).ravel())
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([np.concatenate(codes).tobytes()], pa.binary()),
             pa.array([sizes], pa.list_(pa.int32())), pa.array([np.concatenate(entries).tobytes()], pa.binary())],
            names=["ids", "codes", "sizes", "entries"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, dims)
            own = np.array(batch.column("id").to_pylist(), dtype=object)
            for s in range(0, batch.num_rows, chunk):
                ids.append(own[s:s + chunk])
                held.append(flat[s:s + chunk])
                n += len(held[-1])
                while n >= chunk:
                    all_ids, v = np.concatenate(ids), np.concatenate(held)
                    yield encode(all_ids[:chunk], v[:chunk])
                    ids, held, n = [all_ids[chunk:]], [v[chunk:]], n - chunk
        if n:
            yield encode(np.concatenate(ids), np.concatenate(held))

    return vectors.mapInArrow(work, "ids array<long>, codes binary, sizes array<int>, entries binary")


class Chunk:
    """One chunk read back: its codes and dictionaries by block."""

    def __init__(self, row: dict, dims: int, width: int, chunk: int):
        self.ids = row["ids"]
        n, self.sizes = len(row["ids"]), row["sizes"]
        self.codes = np.frombuffer(row["codes"], np.uint16 if chunk <= 1 << 16 else np.uint32).reshape(len(self.sizes), n)
        flat, self.blocks, at = np.frombuffer(row["entries"], np.int32).astype(np.int64), [], 0
        for s, size in zip(range(0, dims, width), self.sizes, strict=True):
            w = min(width, dims - s)
            self.blocks.append((s, flat[at:at + size * w].reshape(size, w)))
            at += size * w

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of each vector."""
        tables = [((found[:, None, :] - centroids[None, :, s:s + found.shape[1]]) ** 2).sum(axis=2) for s, found in self.blocks]
        n = len(self.ids)
        cluster, distance = np.empty(n, np.int64), np.empty(n, np.int64)
        for start in range(0, n, _AT_ONCE):
            end = min(n, start + _AT_ONCE)
            total = np.zeros((end - start, len(centroids)), np.int64)
            for table, code in zip(tables, self.codes, strict=True):
                total += table[code[start:end]]
            cluster[start:end] = total.argmin(axis=1)
            distance[start:end] = total[np.arange(end - start), cluster[start:end]]
        return cluster, distance

    def sums(self, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and component sums of each cluster."""
        parts = [np.bincount(cluster * size + code, minlength=k * size).reshape(k, size) @ found
                 for size, code, (_, found) in zip(self.sizes, self.codes, self.blocks, strict=True)]
        return np.bincount(cluster, minlength=k), np.concatenate(parts, axis=1)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int, width: int, chunk: int) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0], dims, width, chunk)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    found = vectors.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    return np.array([r["v"] for r in found], dtype=np.int64)


def _round(chunks: DataFrame, shared: Broadcast, dims: int, width: int, chunk: int) -> DataFrame:
    """(cluster, dim, n, total) of the vectors nearest to each centroid."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        k = len(centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for part in _chunks(batches, dims, width, chunk):
            more, sums = part.sums(part.nearest(centroids)[0], k)
            n, total = n + more, total + sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), dims)), pa.array(np.tile(np.arange(dims), k)), pa.array(np.repeat(n, dims)),
             pa.array(total.ravel())], names=["cluster", "dim", "n", "total"])

    return chunks.mapInArrow(work, "cluster long, dim long, n long, total long").filter("n > 0").groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))


def lloyd(chunks: DataFrame, centroids: np.ndarray, rounds: int, dims: int, width: int = WIDTH, chunk: int = CHUNK) -> np.ndarray:
    """The centroids after so many rounds."""
    context = chunks.sparkSession.sparkContext
    for _ in range(rounds if len(centroids) else 0):
        shared = context.broadcast(centroids)
        found = _round(chunks, shared, dims, width, chunk).toArrow()
        c, d, n, total = (found.column(x).to_numpy() for x in ("cluster", "dim", "n", "total"))
        centroids = centroids.copy()
        centroids[c, d] = np.floor_divide(total, n)
        shared.destroy()
    return centroids


def assigned(chunks: DataFrame, centroids: np.ndarray, dims: int, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    shared = chunks.sparkSession.sparkContext.broadcast(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches, dims, width, chunk):
            cluster, distance = part.nearest(shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(part.ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return chunks.mapInArrow(work, "vec_id long, cluster int, distance long")


def cluster_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
                    dims: int = DIMS, scale: int = SCALE, seed: int = SEED, width: int = WIDTH,
                    chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector, and the final centroids, k x dims integers."""
    vectors = integer_vectors(rows, vec_id, vector, dims, scale)
    centroids = first_centroids(vectors, k, seed)
    chunks = stage(encoded(vectors, dims, width, chunk), "vector-chunks")
    centroids = lloyd(chunks, centroids, rounds, dims, width, chunk)
    return stage(assigned(chunks, centroids, dims, width, chunk), "clustered"), centroids
