"""DartMinHash signatures of weighted sets, in numpy over many rows at once.

An element of weight w owns the weight axis from 0 to w, cut into unit cells (the last may be narrower).
Hashed darts fall on (weight, rank): a unit cell gets its darts in rank order, at
exponential gaps drawn from the hash of cell and dart number, so every row that owns the cell sees the same
darts. A dart counts if it falls on weight the row has; it belongs to one hashed coordinate,
and the earliest dart of each coordinate is the signature. Two rows agree in a coordinate with
the probability of their weighted Jaccard similarity.

A row throws darts only up to the rank where k ln k + 2k are expected over its whole
weight; a row with a coordinate still empty goes on to twice the rank. So a row costs its
cells once and k ln k darts, not k times its cells.
"""

from __future__ import annotations

import numpy as np

from clickloom.llm.bytework import MULTIPLIERS, U64, Words, grams, mix, span_hashes

_STEP = U64(MULTIPLIERS[1])
_SALT = U64(0x632BE59BD9B4E019)


def signatures(cells: np.ndarray, first: np.ndarray, k: int, width: np.ndarray | None = None) -> np.ndarray:
    """The k winning darts of each row, as 64 bit numbers; 0 throughout for a row without cells.

    ``cells`` are hashes of unit cells, row r's from first[r] to first[r + 1]; ``width``
    is the part of each cell that is owned, 1 where it is left out.
    """
    rows = len(first) - 1
    n = np.diff(first)
    weight = n.astype(float)
    if width is not None:
        total = np.concatenate([[0.0], np.cumsum(width)])
        weight = total[first[1:]] - total[first[:-1]]
    reach = (k * np.log(k) + 2 * k) / np.maximum(weight, 1e-12)
    row_of = np.repeat(np.arange(rows), n)
    best = np.full(rows * k, np.inf)
    winner = np.zeros(rows * k, dtype=U64)
    seed = mix(cells)
    rank = _gap(seed)  # of each cell's next dart
    number = np.zeros(len(cells), dtype=U64)
    rows_open = n > 0
    while rows_open.any():
        active = np.flatnonzero(rows_open[row_of] & (rank < reach[row_of]))
        while len(active):
            dart = mix(seed[active] ^ _SALT)
            slot = row_of[active] * k + (dart % U64(k)).astype(np.int64)
            at, hit = rank[active], np.ones(len(active), dtype=bool)
            if width is not None:
                hit = (mix(dart) >> U64(11)) * 2.0 ** -53 < width[active]
            s, r, d = slot[hit], at[hit], dart[hit]
            np.minimum.at(best, s, r)
            won = best[s] == r
            winner[s[won]] = d[won]
            number[active] += U64(1)
            seed[active] = mix(cells[active] + number[active] * _STEP)
            rank[active] += _gap(seed[active])
            active = active[rank[active] < reach[row_of[active]]]
        rows_open &= np.isinf(best).reshape(rows, k).any(axis=1)
        reach[rows_open] *= 2
    return winner.reshape(rows, k)


def _gap(seed: np.ndarray) -> np.ndarray:
    return -np.log(((seed >> U64(11)) + U64(1)) * 2.0 ** -53)


def shingle_cells(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of each row's word shingles, weighted by count: one per (shingle, how often before), and the rows' offsets.

    A row of fewer words, but not none, has one shingle of all its words.
    """
    n = np.diff(words.first)
    m = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(m)])
    h = grams(words.hashes, size)
    row_of = np.repeat(np.arange(len(n)), n)[:len(h)]
    whole = words.first[row_of + 1] - np.arange(len(h)) >= size
    cells = np.empty(int(first[-1]), dtype=U64)
    long = np.repeat(n >= size, m)
    cells[long] = h[whole]
    short = (n > 0) & (n < size)
    cells[~long] = span_hashes(words.hashes, words.first[:-1][short], words.first[1:][short])
    # number the equal shingles of a row
    row = np.repeat(np.arange(len(n)), m).astype(U64)
    key = mix(cells + mix(row))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    start = np.flatnonzero(new)
    before = np.empty(len(order), dtype=np.int64)
    before[order] = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return mix(cells + before.astype(U64) * _STEP), first


def contents(words: Words) -> np.ndarray:
    """A hash of each row's words in order."""
    return span_hashes(words.hashes, words.first[:-1], words.first[1:])
