"""Sampling by a trigger: the first row, then each next one at least so many steps or seconds after the last one taken.

What is taken depends on all that was taken before, so the scan carries a state. It is cut into chunks:

1. a chunk of a run (so many steps or seconds of it) tells, for each place where the scan can enter it, where the scan would
   leave it. Entries lie in the chunk's first ``gap`` only, as the last row taken lies before the chunk, and the exit grows
   with the entry: only the places where it changes are kept;
2. the chunks of a run are passed in order, one small row each: where does the scan enter this one?
3. each chunk, given its entry, names the rows taken.

No task holds more than a chunk of a run's rows and a batch, or one row per chunk; chunks are at least CHUNK_GAPS gaps wide unless
told otherwise. Chunks may be many and small: they are worked on batch by batch, not one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.sources.scratch import stage

CHUNK_GAPS = 1024
_AT, _CHUNK, _RUN = "_at", "_chunk", "_run"


def _whole_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by run and chunk, cut anew so that no chunk lies in two."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        run, number = (batch.column(c).to_numpy() for c in (_RUN, _CHUNK))
        changes = np.flatnonzero((run[1:] != run[:-1]) | (number[1:] != number[:-1]))
        cut = int(changes[-1]) + 1 if len(changes) else 0
        if held and (cut or key != (run[0], number[0])):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
        key = (run[-1], number[-1])
    if held:
        yield pa.Table.from_batches(held)


def _lined_up(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Tables of whole chunks with their values, where each chunk starts, the place of each value and the chunks' distance.

    Places put the chunks one after the other, further apart than a gap, so that one search serves them all.
    """
    for table in _whole_chunks(batches):
        run, number, at = (table.column(c).to_numpy() for c in (_RUN, _CHUNK, _AT))
        starts = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (number[1:] != number[:-1])))
        ends = np.append(starts[1:], len(at))
        span = int((at[ends - 1] - at[starts]).max()) + gap + 1
        most = max(1, (1 << 62) // span)
        for i in range(0, len(starts), most):
            lo, hi = int(starts[i]), int(ends[min(i + most, len(ends)) - 1])
            begin, values = starts[i:i + most] - lo, at[lo:hi]
            of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, hi - lo)))
            yield table.slice(lo, hi - lo), values, begin, values - values[begin][of] + of * span, span


def _following(place: np.ndarray, starts: np.ndarray, gap: int) -> np.ndarray:
    """The row taken after each row, in its chunk (the number of all rows: none)."""
    n = len(place)
    ends = np.append(starts[1:], n)
    following = np.searchsorted(place, place + gap)
    return np.where(following < np.repeat(ends, ends - starts), following, n)


def _last(following: np.ndarray) -> np.ndarray:
    """The last row taken from each row on."""
    n = len(following)
    last, jump = np.arange(n + 1), np.append(following, n)
    while (jump[:n] < n).any():  # each round follows twice as many rows
        last = np.where(jump < n, last[np.minimum(jump, n - 1)], last)
        jump = jump[jump]
    return last[:n]


def _exits(gap: int, chunk: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at, starts, place, _ in _lined_up(batches, gap):
            last = _last(_following(place, starts, gap))
            begins = np.zeros(len(at), bool)
            begins[starts] = True
            due = table.column(_CHUNK).to_numpy() * chunk + gap
            entries = np.flatnonzero(begins | np.append(True, at[:-1] < due[1:]))
            out = at[last[entries]]
            # of a chunk's entries with one exit the last one stands for all
            keep = np.append((out[1:] != out[:-1]) | begins[entries[1:]], True)
            entries, out = entries[keep], out[keep]
            ends = pa.array(np.searchsorted(entries, np.append(starts, len(at))), pa.int32())
            yield pa.RecordBatch.from_pydict({
                _RUN: table.column(_RUN).to_numpy()[starts], _CHUNK: table.column(_CHUNK).to_numpy()[starts], "first": at[starts],
                "entries": pa.ListArray.from_arrays(ends, pa.array(at[entries])), "exits": pa.ListArray.from_arrays(ends, pa.array(out))})

    return work


def _entries(gap: int):
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by(_CHUNK)
        out, due = [], None
        for first, entries, exits in zip(*(table.column(c) for c in ("first", "entries", "exits")), strict=True):
            due = first.as_py() if due is None else due
            out.append(due)
            at = int(np.searchsorted(entries.values.to_numpy(), due))
            # beyond the last entry no row of the chunk is due
            due = exits.values[at].as_py() + gap if at < len(entries.values) else due
        return pa.table({_RUN: table.column(_RUN), _CHUNK: table.column(_CHUNK), "due": pa.array(out, pa.int64())})

    return work


def _taken(gap: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at, starts, place, span in _lined_up(batches, gap):
            following = np.append(_following(place, starts, gap), len(at))
            # an entry before the chunk is its first row, one beyond its rows is none of them
            first, last = at[starts], at[np.append(starts[1:], len(at)) - 1]
            due = np.clip(table.column("due").to_numpy()[starts], first, last)
            rows = np.searchsorted(place, due - first + np.arange(len(starts)) * span)
            rows = rows[table.column("due").to_numpy()[starts] <= last]
            taken = np.zeros(len(at), bool)
            while len(rows):  # the next row of every chunk
                taken[rows] = True
                rows = following[rows]
                rows = rows[rows < len(at)]
            yield pa.RecordBatch.from_pydict({_RUN: table.column(_RUN).to_numpy()[taken], _AT: at[taken]})

    return work


def _by_chunk(rows: DataFrame) -> DataFrame:
    """Rows of a chunk in one task, one after the other; many small chunks are worked on at once.

    They are dealt by a hash, not by the columns: a shuffle by these could be taken as done by a join before it, and cut by it.
    """
    return rows.repartition(F.xxhash64(_RUN, _CHUNK)).sortWithinPartitions(_RUN, _CHUNK, _AT)


def triggered(rows: DataFrame, at: Column, gap: int, by: Sequence[str], chunk: int | None = None) -> DataFrame:
    """(``by``, ``_at``): the values of ``at``, a whole number, that the trigger takes in each run.

    The first value of a run is taken, then each first one that is ``gap`` or more beyond the last one taken. Rows without a
    value are no part of it. Runs are told apart by a 64 bit hash of ``by``, which comes back with the result.
    """
    if gap <= 0:
        raise ValueError("the gap must be positive")
    chunk = chunk or gap * CHUNK_GAPS
    if chunk < gap:
        raise ValueError("a chunk must hold a gap")
    number = at.cast("bigint")
    values = rows.select(*by, number.alias(_AT)).where(F.col(_AT).isNotNull()).distinct()
    values = stage(values.withColumn(_RUN, F.xxhash64(*by)).withColumn(_CHUNK, F.floor(F.col(_AT) / F.lit(chunk)).cast("bigint")), "triggers")
    kind = {_RUN: T.LongType(), _CHUNK: T.LongType()}
    keys = [T.StructField(c, k) for c, k in kind.items()]
    exits = _by_chunk(values.select(_RUN, _CHUNK, _AT)).mapInArrow(_exits(gap, chunk), T.StructType([
        *keys, T.StructField("first", T.LongType()), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("entries", "exits"))]))
    entries = exits.groupBy(_RUN).applyInArrow(_entries(gap), T.StructType([*keys, T.StructField("due", T.LongType())]))
    due = stage(entries, "trigger-entries")
    taken = _by_chunk(values.select(_RUN, _CHUNK, _AT).join(due, [_RUN, _CHUNK])).mapInArrow(
        _taken(gap), T.StructType([keys[0], T.StructField(_AT, T.LongType())]))
    return values.join(taken, [_RUN, _AT]).select(*by, _AT)
