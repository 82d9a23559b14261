"""Conflict-constrained best-fit packing of documents into bins of equal capacity.

Documents are measured in tokens (runs of characters other than white space, unless a size column is
named). One longer than the capacity is cut into full pieces and a rest. Pieces are dealt evenly into shards
of about SHARD_ROWS; a shard is packed in one task: largest first, each into the
compatible bin that it fills most. A bin takes no two pieces of one source, and no two of one
duplicate cluster (equal words in order in any case, unless a cluster column is named: classes of near copies are given
that way, without one near copies may share a bin); pieces of one document share both, so
they never share a bin.

Bins are ordered by residual. Each residual has a bitmap of its bins, each source and each cluster
a bitmap of the bins that hold it; the compatible bins of a residual are the first without the other
two. The search starts at the residual equal to the size and goes on to the next larger that
has bins until one is compatible; of equal residuals the oldest bin wins.

Edge cases: null and empty texts, and null sizes of a size column, have size 0: they are placed as pieces of no tokens, in the
fullest compatible bin; null sources conflict with nothing; documents without words are in no
cluster; rows are not told apart by doc_id, so null and repeated ids are packed like others (repeated texts are one
cluster); an empty table has no rows; further columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.frames import stage

CAPACITY = 2048
SHARD_ROWS = 8192

PLACED = "doc_id long, piece int, start_token long, n_tokens long, bin_id string, bin_offset long, bin_tokens long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start_token", pa.int64()), ("n_tokens", pa.int64()),
                    ("bin_id", pa.string()), ("bin_offset", pa.int64()), ("bin_tokens", pa.int64())])


class Bins:
    """The bins of one shard."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.used: list[int] = []
        self.at: list[int] = [0] * (capacity + 1)  # by residual, the bitmap of its bins
        self.some = 0  # the bitmap of residuals that have bins
        self.holds: defaultdict[tuple, int] = defaultdict(int)  # by source or cluster, the bitmap of bins that hold it

    def best(self, size: int, marks: list[tuple]) -> int | None:
        """The compatible bin with the least residual that is no less than the size."""
        taken = 0
        for mark in marks:
            taken |= self.holds[mark]
        rest = self.some >> size
        residual = size
        while rest:
            step = (rest & -rest).bit_length() - 1  # the next residual that has bins
            residual += step
            if free := self.at[residual] & ~taken:
                return (free & -free).bit_length() - 1
            rest >>= step + 1
            residual += 1
        return None

    def put(self, size: int, marks: list[tuple]) -> tuple[int, int]:
        """The bin and the offset that a piece gets."""
        b = self.best(size, marks)
        if b is None:
            b = len(self.used)
            self.used.append(0)
            offset = 0
        else:
            offset = self.used[b]
            old = self.capacity - offset
            self.at[old] &= ~(1 << b)
            if not self.at[old]:
                self.some &= ~(1 << old)
        self.used[b] += size
        left = self.capacity - self.used[b]
        self.at[left] |= 1 << b
        self.some |= 1 << left
        for mark in marks:
            self.holds[mark] |= 1 << b
        return b, offset


def n_tokens(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"\S+")).cast("long")


def word_cluster(text: str) -> Column:
    """One number for texts of equal words: their hash, null where there are none."""
    flat = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"\s+", " "))
    return F.when(flat != "", F.xxhash64(flat))


def pack(docs: DataFrame, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         size: Column | None = None, cluster: Column | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, piece, start_token, n_tokens, bin_id, bin_offset, bin_tokens): one row per piece."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(source).cast("string")).alias("source_hash"),
        F.col(source).isNull().alias("no_source"), F.coalesce((size if size is not None else n_tokens(text)).cast("long"), F.lit(0)).alias("size"),
        (cluster if cluster is not None else word_cluster(text)).alias("cluster"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int")
    rows = rows.select(
        "doc_id", F.when(~F.col("no_source"), F.col("source_hash")).alias("source"), "cluster", "size",
        F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    rows = rows.select("doc_id", "piece", "source", "cluster", start.alias("start_token"),
                       F.least(F.lit(capacity).cast("long"), F.col("size") - start).alias("n_tokens"))
    return pack_pieces(rows, capacity, shard_rows)


def pack_pieces(rows: DataFrame, capacity: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Packs (doc_id, piece, source, cluster, start_token, n_tokens) rows; sources and clusters are numbers or null."""
    rows = stage(rows, "pieces")
    shards = max(1, -(-rows.count() // shard_rows))
    # by place in the staged table: no source, cluster, document or repeated row fills a shard
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).alias("shard")

    def work(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("piece").to_numpy(), table.column("doc_id").fill_null(-1).to_numpy(),
                            -table.column("n_tokens").to_numpy()))
        table = table.take(pa.array(order))
        bins, where, offsets = Bins(capacity), [], []
        for s, c, n in zip(table.column("source").to_pylist(), table.column("cluster").to_pylist(),
                           table.column("n_tokens").to_pylist(), strict=True):
            marks = [m for m in (("source", s), ("cluster", c)) if m[1] is not None]
            b, offset = bins.put(n, marks)
            where.append(b)
            offsets.append(offset)
        name = table.column("shard")[0].as_py() if len(table) else 0
        return pa.table({
            "doc_id": table.column("doc_id"), "piece": table.column("piece"), "start_token": table.column("start_token"),
            "n_tokens": table.column("n_tokens"), "bin_id": pa.array([f"{name}-{b}" for b in where], pa.string()),
            "bin_offset": pa.array(offsets, pa.int64()), "bin_tokens": pa.array([bins.used[b] for b in where], pa.int64()),
        }, schema=_ARROW)

    return rows.select(*rows.columns, shard).groupBy("shard").applyInArrow(work, PLACED)
