"""Line dedup over levelled sorted runs of line hashes.

A run holds, for the lines of one batch of documents, (hash, number of documents,
largest doc_id), sorted by hash. ``LineRuns.add`` writes a batch's run at level 0; when
a level holds ``fanout`` runs they are merged into one run of the next level. Lines of
a batch are then merge-joined with the runs: what is found often enough is anti-joined
away from all but its last document.

A line's key is the line without white space at both ends and with A-Z in lower case.
Only keys of ``least_chars`` code points or more count. Edge cases:

* null and empty texts are one empty line and stay as they are (null stays null in ``dedup_lines``);
* documents are told apart by doc_id: rows that repeat a doc_id count once, and all
  rows of the largest doc_id keep the line; null doc_ids count as one document, the smallest;
* an empty table gives an empty result; further columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.bytework import U64, lower_ascii, mix, slices, span_hashes, text_array, text_buffer
from clickloom.llm.frames import fresh, stage

#: The shortest key that counts, and in how many documents it must be.
LEAST_CHARS = 20
LEAST_DOCS = 3
#: Runs of one level that are merged into one of the next.
FANOUT = 4
#: Batches that a whole table is added in.
BATCHES = 4

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


class Lines:
    """The lines of the rows of a text column: byte spans, and hashes of those whose key is long enough."""

    def __init__(self, column: pa.Array, least_chars: int):
        self.data, at = text_buffer(column)
        breaks = np.flatnonzero(self.data == 10)
        breaks = breaks.astype(np.int64)
        rows = len(at) - 1
        # a row of k line breaks has k + 1 lines, so each row ends one more
        inside = np.searchsorted(breaks, at)
        self.per_row = np.diff(inside) + 1
        self.first = np.concatenate([[0], np.cumsum(self.per_row)])
        self.row = np.repeat(np.arange(rows), self.per_row)
        n = int(self.first[-1])
        self.starts, self.ends = np.empty(n, np.int64), np.empty(n, np.int64)
        ends_row = np.zeros(n, dtype=bool)
        ends_row[self.first[1:] - 1] = True
        self.ends[ends_row] = at[1:]
        self.ends[~ends_row] = breaks
        starts_row = np.zeros(n, dtype=bool)
        starts_row[self.first[:-1]] = True
        self.starts[starts_row] = at[:-1]
        self.starts[~starts_row] = breaks + 1
        # the key's span: from the next byte that isn't white space, to the last one
        solid = np.flatnonzero(~_SPACE[self.data])
        i, j = np.searchsorted(solid, self.starts), np.searchsorted(solid, self.ends)
        some = j > i
        key_start = np.where(some, solid[np.minimum(i, len(solid) - 1)] if len(solid) else 0, self.starts)
        key_end = np.where(some, solid[np.maximum(j - 1, 0)] + 1 if len(solid) else 0, self.starts)
        head = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        self.counts = head[key_end] - head[key_start] >= least_chars
        low = lower_ascii(self.data)
        self.h1 = span_hashes(low, key_start[self.counts], key_end[self.counts], 0).view(np.int64)
        self.h2 = span_hashes(low, key_start[self.counts], key_end[self.counts], 1).view(np.int64)
        self.key_row = self.row[self.counts]

    def distinct(self) -> np.ndarray:
        """Indices of the first line of each (row, key)."""
        order = np.lexsort((self.h2, self.h1, self.key_row))
        r, a, b = self.key_row[order], self.h1[order], self.h2[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return order[new]


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, h1, h2): the keys of each row, each once per row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            lines = Lines(part.column("text"), least_chars)
            pick = lines.distinct()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc").take(pa.array(lines.key_row[pick])), pa.array(lines.h1[pick]),
                 pa.array(lines.h2[pick])], names=["doc", "h1", "h2"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc long, h1 long, h2 long")


class LineRuns:
    """The runs by level; every run is a staged table sorted by hash within its files."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for run in runs[1:]:
            both = both.unionByName(run)
        return both.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def add(self, keys: DataFrame) -> None:
        """Adds one batch of ``line_keys``; a doc_id must not come in two batches."""
        # first the copies of a document, then documents: a line that all documents hold is summed before it moves
        found = keys.select("h1", "h2", "doc").distinct().groupBy("h1", "h2").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last_doc"))
        self._put(found, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(stage(run.sortWithinPartitions("h1", "h2"), f"line-run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(self._merged(full), level + 1)

    def repeated(self, least_docs: int = LEAST_DOCS) -> DataFrame:
        """(h1, h2, last_doc) of the keys found in enough documents over all runs."""
        runs = [run for level in self.levels for run in level]
        return self._merged(runs).filter(F.col("n_docs") >= least_docs).select("h1", "h2", "last_doc")


def runs_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
            batches: int = BATCHES, fanout: int = FANOUT) -> LineRuns:
    """The runs of a whole table, added in batches of documents."""
    runs = LineRuns(docs.sparkSession, fanout)
    batch = F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(batches))
    for b in range(batches):
        runs.add(line_keys(docs.filter(batch == b), doc_id, text, least_chars))
    return runs


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                least_docs: int = LEAST_DOCS, runs: LineRuns | None = None) -> DataFrame:
    """All rows and columns with repeated lines taken out of the text, and n_lines, n_dropped added.

    Names of added columns get a leading underscore where the table has them already.
    """
    runs = runs or runs_of(docs, doc_id, text, least_chars)
    # staged, the join reads two plain shuffles, so Spark can split a line that many documents hold
    mine, again = line_keys(docs, doc_id, text, least_chars), stage(runs.repeated(least_docs), "repeated-lines")
    lost = (mine.join(again, ["h1", "h2"])
            .filter(F.col("doc").isNull() & F.col("last_doc").isNotNull() | (F.col("doc") < F.col("last_doc")))
            .groupBy("doc").agg(F.collect_set("h1").alias("h1"), F.collect_set("h2").alias("h2")))
    d, a, b = (fresh(docs.columns, n) for n in ("lost_doc", "lost_h1", "lost_h2"))
    n_lines, n_dropped = fresh(docs.columns, "n_lines"), fresh(docs.columns, "n_dropped")
    lost = lost.select(F.col("doc").alias(d), F.col("h1").alias(a), F.col("h2").alias(b))
    joined = docs.join(lost, F.col(doc_id).cast("long").eqNullSafe(F.col(d)), "left").drop(d)
    schema = docs.select(*docs.columns).schema.add(n_lines, "long").add(n_dropped, "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            lines = Lines(part.column(text), least_chars)
            drop = np.zeros(len(lines.row), dtype=bool)
            drop[lines.counts] = (_listed(part.column(a), lines.key_row, lines.h1)
                                  & _listed(part.column(b), lines.key_row, lines.h2))
            n_lost = np.bincount(lines.row[drop], minlength=part.num_rows).astype(np.int64)
            columns = {name: part.column(name) for name in part.schema.names if name not in (a, b)}
            columns[text] = _rebuilt(lines, ~drop, part.column(text))
            columns[n_lines] = pa.array(lines.per_row.astype(np.int64))
            columns[n_dropped] = pa.array(n_lost)
            yield pa.RecordBatch.from_pydict(columns)

    return joined.mapInArrow(work, schema)


def _listed(lists: pa.Array, row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each (row, value) is in that row's list."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.repeat(np.arange(len(lengths)), lengths)
    return np.isin(_paired(row, value), _paired(at, flat))


def _paired(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(mix(row.astype(U64)) + value.astype(np.int64).view(U64))


def _rebuilt(lines: Lines, keep: np.ndarray, column: pa.Array) -> pa.Array:
    """The kept lines of each row, joined by line breaks; null texts stay null."""
    last = np.zeros(len(keep), dtype=bool)  # the last kept line of a row has no break behind it
    kept = np.flatnonzero(keep)
    rows = lines.row[kept]
    last[kept[np.append(rows[1:] != rows[:-1], True) if len(kept) else []]] = True
    width = np.where(keep, lines.ends - lines.starts + ~last, 0)
    size = np.bincount(lines.row, weights=width, minlength=len(column)).astype(np.int64)
    total = int(width.sum())
    take = np.repeat(lines.starts - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(total)
    out = text_array(lines.data[take], np.concatenate([[0], np.cumsum(size)])).cast(pa.string())
    return pc.if_else(column.is_valid(), out, pa.scalar(None, pa.string())) if column.null_count else out
