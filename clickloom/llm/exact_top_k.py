"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists.

Vectors become integers, floor(scale * x). Candidates are dealt into blocks and
queries into groups; each (block, group) cell is one task's work: for every dimension
the block's candidates are listed by value, and a query reads all lists in step, from the top
where its component is positive, from the bottom where negative. Candidates met
for the first time are scored in full; the best score a candidate not met yet can have is
the sum over dimensions of the component times the value last read. Reading stops when that
bound is below the kth score so far (not equal: an unseen tie could have a smaller id).
The cells' k best per query are merged. Depth grows by doubling steps.

A cell holds about BLOCK_ROWS candidates and GROUP_ROWS queries whatever the table's size; candidates
are repeated once per query group, queries once per block, nothing is broadcast.

Edge cases: vectors that are null, empty or hold null or non-finite components
take no part; rows equal in id and vector count once, rows of one id with different vectors are all
candidates, never for queries of that id, and a query each; vectors of different lengths never meet; null ids take no part;
ties go to the smaller id; fewer than k candidates give fewer rows; an empty table gives none.
Scores beyond 2^53 in size are computed in exact integers, more slowly; components
beyond 2^31 after scaling raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8_192
GROUP_ROWS = 2_048
SCALE = 256
#: Entries read from each list before the first look at the bound.
FIRST_DEPTH = 16


def scaled_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v): the usable vectors as integers."""
    double = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = (F.col(vec_id).isNotNull() & (F.size(vector) > 0)
              & F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return rows.filter(usable).select(F.col(vec_id).cast("long").alias("id"),
                                      F.transform(double, lambda x: F.floor(x * scale).cast("long")).alias("v")).distinct()


def threshold_search(query: np.ndarray, own: int, ids: np.ndarray, block: np.ndarray, lists: np.ndarray,
                     k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of a block for one query; ``lists`` has the rows by value, ascending, for each dimension."""
    n = len(ids)
    dims = np.flatnonzero(query)  # a zero component adds nothing, whatever the value
    if not len(dims):
        dims = np.array([0])
    q = query[dims]
    down = q > 0
    falling, rising = dims[down], dims[~down]
    seen = np.zeros(n, dtype=bool)
    score, met = np.empty(0, dtype=block.dtype), np.empty(0, dtype=np.int64)
    start, depth = 0, min(FIRST_DEPTH, n)
    while True:
        fresh = np.zeros(n, dtype=bool)
        fresh[lists[falling, n - depth:n - start]] = True
        fresh[lists[rising, start:depth]] = True
        fresh &= ~seen
        seen |= fresh
        new = np.flatnonzero(fresh)
        new = new[ids[new] != own]
        met, score = np.concatenate([met, new]), np.concatenate([score, block[new] @ query])
        if len(met) > k:  # all that tie with the kth stay until ids decide
            stay = score >= np.partition(score, len(score) - k)[len(score) - k]
            met, score = met[stay], score[stay]
        if depth == n:
            break
        bound = (block[lists[dims, np.where(down, n - depth, depth - 1)], dims] * q).sum()
        if len(met) >= k and bound < score.min():
            break
        start, depth = depth, min(n, 2 * depth)
    best = np.lexsort((ids[met], -score))[:k]
    return [(int(score[i]), int(ids[met[i]])) for i in best]


def _cell(k: int):
    def work(key: tuple, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(candidates) or not len(queries):
            return pd.DataFrame(columns=columns).astype("int64")
        ids = candidates["id"].to_numpy(np.int64)
        block, asked = np.stack(candidates["v"].to_numpy()).astype(np.int64), np.stack(queries["v"].to_numpy()).astype(np.int64)
        most = max(int(np.abs(block).max()), 1) * max(int(np.abs(asked).max()), 1) * block.shape[1]
        if max(int(np.abs(block).max()), int(np.abs(asked).max())) >= 1 << 31:
            raise ValueError("a scaled component is beyond 2^31")
        kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object
        block, asked = block.astype(kind), asked.astype(kind)
        lists = np.ascontiguousarray(np.argsort(block, axis=0, kind="stable").T)
        out = []
        for own, query in zip(queries["id"].tolist(), asked, strict=True):
            out += [(own, i, s) for s, i in threshold_search(query, own, ids, block, lists, k)]
        return pd.DataFrame(out, columns=columns).astype("int64")

    return work


def exact_top_k(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
                scale: int = SCALE, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for each row that ``is_query`` (of ``vec_id``) picks."""
    vectors = scaled_vectors(rows, vec_id, vector, scale)
    queries = scaled_vectors(rows.filter(is_query), vec_id, vector, scale)
    n = rows.count()
    blocks = max(1, -(-n // block_rows))
    groups = max(1, -(-rows.filter(is_query).count() // group_rows))
    spread = F.xxhash64("id", "v")
    size = F.size("v").alias("size")
    left = vectors.select("id", "v", size, F.pmod(spread, F.lit(blocks)).cast("int").alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = queries.select("id", "v", size, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                           F.pmod(spread, F.lit(groups)).cast("int").alias("group"))
    cell = ["size", "block", "group"]
    best = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_cell(k), "query_id long, vec_id long, score long")
    # a query that one id asks with two vectors gets the best of both
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
