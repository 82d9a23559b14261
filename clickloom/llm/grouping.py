"""Groups of consecutive rows from a stream of Arrow batches, for partitions sorted by the groups' keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group, one group after the other; keys are numbers without nulls."""
    held: list[pa.Table] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        values = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys])
        cuts = np.flatnonzero(np.append(True, (values[:, 1:] != values[:, :-1]).any(axis=0)))
        for start, end in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows], strict=True):
            mine = tuple(values[:, start].tolist())
            if held and mine != key:
                yield pa.concat_tables(held)
                held = []
            key = mine
            held.append(table.slice(start, end - start))
    if held:
        yield pa.concat_tables(held)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, many at once, and where each group ends for every row; for groups of bounded size."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        values = table.column(key).to_numpy()
        others = np.flatnonzero(values != values[-1])
        first = int(others[-1]) + 1 if len(others) else 0
        held = table.slice(first)
        if first:
            yield table.slice(0, first), _ends(values[:first])
    if held is not None:
        yield held, _ends(held.column(key).to_numpy())


def _ends(values: np.ndarray) -> np.ndarray:
    cuts = np.append(np.flatnonzero(values[1:] != values[:-1]) + 1, len(values))
    return np.repeat(cuts, np.diff(np.append(0, cuts)))
