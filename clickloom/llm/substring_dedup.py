"""Exact substring dedup: bytes covered by a string of ``length`` (100) bytes that also starts earlier are removed.

"Earlier" is in a document of smaller doc_id, or in the same one further left; overlaps count, and all strings are judged on the
input. Suffix arrays find the repeats; so that equal strings meet in one array, pieces of text are routed by content:

1. The anchor of a string is its least-hashed 32-gram (the leftmost of equals), so equal strings have equal
   anchors. Consecutive strings of one anchor are one piece: its owner strings and nothing else. A piece is known by its
   anchor's hash and its own. Equal pieces are folded onto the earliest: within a
   slice of documents at once, then by a sorted shuffle. What is folded is removed.
2. An anchor that one piece is left of repeats nothing further. Pieces of anchors with several come as
   bytes to shards of the anchor's hash: bounded suffix arrays by induced sorting, whose permuted common prefixes
   of ``length`` or more group the strings; all but the earliest of a group are removed.
   An anchor of more than ``most_pieces`` pieces is routed string by string instead, by
   the hash of each string, so it spreads over all shards whole; a string that no other has the hash of needs no array.
3. Removed spans are united per document and cut out.

Edge cases: null texts are empty; a null doc_id is smaller than any other; rows that repeat a doc_id and its text
are one document and get equal results; rows of one doc_id with different texts are separate ones, ordered by
the texts' hashes; texts shorter than ``length`` lose nothing; bytes need not be whole characters afterwards; an empty table has no rows;
further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytework import MULTIPLIERS, U64, mix, slices, span_hashes, text_buffer, window_min
from clickloom.llm.frames import stage
from clickloom.llm.suffix_array import permuted_common_prefixes, suffix_array

LENGTH = 100
GRAM = 32
#: Pieces of one anchor that go to one shard, and bytes of a suffix array.
MOST_PIECES = 2048
SHARD_BYTES = 1 << 20
#: Bytes of cut pieces that are written out at once.
EMIT_BYTES = 8 << 20

_LEAST = -(1 << 63)
_LOW = U64(0xFFFFFFFF)
#: What a row says: bytes to remove, a piece whose bytes are needed, strings that are routed one by one.
REMOVE, PIECE, STRINGS = 0, 1, 2

_PLACE = "doc long, ident long, start long"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, by doubling."""
    out, have = data.astype(U64) + U64(1), 1
    while have < GRAM:
        factor = U64(pow(MULTIPLIERS[0], have, 1 << 64))
        out = out[:len(out) - have] * factor + out[have:] if len(out) > have else out[:0]
        have *= 2
    return mix(out)


def _pieces(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start in the buffer, number of strings, anchor hash, piece hash) of all pieces of the rows."""
    h = _gram_hashes(data)
    width = length - GRAM + 1
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U64), none.astype(U64)
    owner = (window_min((h & ~_LOW) | np.arange(len(h), dtype=U64), width) & _LOW).astype(np.int64)[:n]
    long = np.flatnonzero(np.diff(at) >= length)
    edge = np.zeros(n + 1, dtype=np.int8)
    edge[at[long]] += 1
    edge[at[long + 1] - length + 1] -= 1
    whole = np.cumsum(edge[:n]) > 0  # strings that lie in one row
    first = whole.copy()
    first[1:] &= (owner[1:] != owner[:-1]) | ~whole[:-1]
    starts = np.flatnonzero(first)
    last = whole.copy()
    last[:-1] &= first[1:] | ~whole[1:]
    ends = np.flatnonzero(last) + 1
    row = np.searchsorted(at, starts, side="right") - 1
    return row, starts, ends - starts, h[owner[starts]], span_hashes(data, starts, ends + length - 1)


def _union(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each row, sorted and with those that touch united."""
    if not len(row):
        return row, start, end
    by = np.lexsort((start, row))
    row, start, end = row[by], start[by], end[by]
    shift = row.astype(np.int64) << 40  # so that the running maximum of ends starts anew in each row
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(row), dtype=bool)
    new[1:] = start[1:] + shift[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], reach[last] - shift[last]


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if getattr(c, "dtype", None) == U64 else c) for c in columns],
                                      names=names.split())


def anchored_pieces(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, piece, doc, ident, start, n) of the pieces, folded per slice; n = 0: ``piece`` bytes from start on are removed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, at = text_buffer(part.column("text"))
            doc, ident = (part.column(c).to_numpy() for c in ("doc", "ident"))
            row, start, n, anchor, piece = _pieces(data, at, length)
            start -= at[row]
            by = np.lexsort((start, ident[row], doc[row], piece, anchor))
            row, start, n, anchor, piece = (x[by] for x in (row, start, n, anchor, piece))
            fresh = np.ones(len(row), dtype=bool)
            fresh[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
            again = ~fresh
            # a row listed twice does not repeat itself
            again[1:] &= (doc[row[1:]] != doc[row[:-1]]) | (ident[row[1:]] != ident[row[:-1]]) | (start[1:] != start[:-1])
            r, s, e = _union(row[again], start[again], start[again] + n[again] + length - 1)
            spread = mix(ident[r].view(U64) + s.astype(U64))
            yield _batch("anchor piece doc ident start n", *(np.concatenate(x) for x in (
                (anchor[fresh].view(np.int64), spread.view(np.int64)), (piece[fresh].view(np.int64), e - s),
                (doc[row[fresh]], doc[r]), (ident[row[fresh]], ident[r]), (start[fresh], s),
                (n[fresh].astype(np.int64), np.zeros(len(r), np.int64)))))

    return docs.select("doc", "ident", "text").mapInArrow(work, f"anchor long, piece long, {_PLACE}, n long")


def folded_pieces(pieces: DataFrame, length: int, most_pieces: int) -> DataFrame:
    """(doc, ident, start, n, anchor, kind): what is removed by folding, and what must be looked at as bytes.

    Streams over partitions sorted by anchor, piece, place. Held back are the distinct pieces of the anchor at
    hand, ``most_pieces`` at most.
    """
    names = ("anchor", "piece", "doc", "ident", "start", "n")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((6, 0), dtype=np.int64)  # distinct pieces of the last anchor
        last = None  # the last row before the batch
        flooded = None  # an anchor that had too many pieces

        def out(x: np.ndarray, kind: int) -> pa.RecordBatch:
            if kind == REMOVE:
                n = np.where(x[5] == 0, x[1], x[5] + length - 1)
                return _batch("doc ident start n anchor kind", x[2], x[3], x[4], n, x[0], np.zeros(x.shape[1], np.int32))
            return _batch("doc ident start n anchor kind", x[2], x[3], x[4], x[5], x[0], np.full(x.shape[1], kind, np.int32))

        def closed(x: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Distinct pieces of whole anchors."""
            if not x.shape[1]:
                return
            cut = np.flatnonzero(np.append(True, x[0, 1:] != x[0, :-1]))
            count = np.diff(np.append(cut, x.shape[1]))
            each = np.repeat(count, count)
            yield out(x[:, (each > 1) & (each <= most_pieces)], PIECE)
            yield out(x[:, each > most_pieces], STRINGS)

        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(c).to_numpy() for c in names])
            yield out(x[:, x[5] == 0], REMOVE)
            x = x[:, x[5] != 0]
            if not x.shape[1]:
                continue
            prior = np.concatenate([last if last is not None else x[:, :1] - 1, x[:, :-1]], axis=1)
            fresh = (x[0] != prior[0]) | (x[1] != prior[1])
            repeat = ~fresh & ((x[2] != prior[2]) | (x[3] != prior[3]) | (x[4] != prior[4]))
            last = x[:, -1:]
            yield out(x[:, repeat], REMOVE)
            x = x[:, fresh]
            if flooded is not None:
                more = x[0] == flooded
                yield out(x[:, more], STRINGS)
                x = x[:, ~more]
                if not x.shape[1]:
                    continue
                flooded = None
            x = np.concatenate([held, x], axis=1)
            if not x.shape[1]:
                continue
            ongoing = x[0] == x[0, -1]
            yield from closed(x[:, ~ongoing])
            held = x[:, ongoing]
            if held.shape[1] > most_pieces:
                flooded = held[0, 0]
                yield out(held, STRINGS)
                held = held[:, :0]
        yield from closed(held)

    dealt = pieces.repartition("anchor").sortWithinPartitions("anchor", "piece", "doc", "ident", "start")
    return dealt.mapInArrow(work, f"{_PLACE}, n long, anchor long, kind int")


def cut_pieces(part: pa.RecordBatch, length: int, emit_bytes: int = EMIT_BYTES) -> Iterator[pa.RecordBatch]:
    """The wanted pieces of some texts with their bytes, in batches of about ``emit_bytes``.

    A piece routed string by string has n * length bytes; it is cut into runs of strings first, so what is held does not grow with it.
    """
    data, at = text_buffer(part.column("text"))
    doc, ident = (part.column(c).to_numpy() for c in ("doc", "ident"))
    lists = part.column("wanted")
    count = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    row = np.repeat(np.arange(part.num_rows), count)
    flat = lists.flatten()
    start, n, anchor, kind = (flat.field(c).to_numpy() for c in ("start", "n", "anchor", "kind"))
    by = np.lexsort((start, row))  # neighbours in the text are cut together
    row, start, n, anchor, one = row[by], start[by], n[by].astype(np.int64), anchor[by], kind[by] == STRINGS
    most = max(1, emit_bytes // length)
    runs_of = np.where(one, -(-n // most), 1)
    inner = (np.arange(int(runs_of.sum())) - np.repeat(np.cumsum(runs_of) - runs_of, runs_of)) * most
    row, start, n, anchor, one = (np.repeat(x, runs_of) for x in (row, start, n, anchor, one))
    start = start + inner
    n = np.where(one, np.minimum(most, n - inner), n)
    cost = np.cumsum(np.where(one, n * length, n + length - 1))
    cuts = np.flatnonzero(np.append(True, cost[1:] // emit_bytes != cost[:-1] // emit_bytes)) if len(n) else np.zeros(0, np.int64)
    for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(n)], strict=False):
        yield _with_bytes(data, at, doc, ident, length, *(x[s:e] for x in (row, start, n, anchor, one)))


def _with_bytes(data: np.ndarray, at: np.ndarray, doc: np.ndarray, ident: np.ndarray, length: int, row: np.ndarray,
                start: np.ndarray, n: np.ndarray, anchor: np.ndarray, one: np.ndarray) -> pa.RecordBatch:
    if one.any():
        times = np.where(one, n, 1)
        inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        row, start, n, anchor, one = (np.repeat(x, times) for x in (row, start, n, anchor, one))
        start, n = start + inner, np.where(one, 1, n)
        begin = at[row] + start
        low, high = int(begin[one].min()), int(begin[one].max()) + length
        strings = span_hashes(data[low:high], begin[one] - low, begin[one] - low + length)
        anchor[one] = strings.view(np.int64)
    begin = at[row] + start
    size = n + length - 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
    cut = pa.Array.from_buffers(pa.binary(), len(row), [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[take]))])
    return _batch("anchor bytes doc ident start n", anchor, cut, doc[row], ident[row], start, n)


def piece_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, bytes, doc, ident, start, n) of the wanted pieces; those routed string by string have the string's hash as anchor."""
    lists = wanted.groupBy("doc", "ident").agg(F.collect_list(F.struct("start", "n", "anchor", "kind")).alias("wanted"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield from cut_pieces(part, length)

    # a left join, so that Spark reuses this shuffle of the texts for the last join
    found = docs.join(lists, ["doc", "ident"], "left").select("doc", "ident", "text", "wanted")
    return found.mapInArrow(work, f"anchor long, bytes binary, {_PLACE}, n long")


def repeats_by_suffix_array(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Places in the data whose string of ``length`` bytes also starts at an earlier one.

    ``rank`` orders the places of each piece: piece i's place p ranks (rank[i], p), pieces of one document by their start.
    """
    text, order = suffix_array(data, offsets)
    _, common = permuted_common_prefixes(text, order)
    group = np.cumsum(common[order] < length)  # neighbours in the array with a long common prefix are of one group
    m = len(offsets) - 1
    piece = np.repeat(np.arange(m), np.diff(offsets) + 1)
    inside = np.arange(len(text)) - (offsets[:-1] + np.arange(m))[piece]
    room = (np.diff(offsets)[piece] - inside) >= length
    where = order[room[order]]
    group = group[room[order]]
    place = rank[piece[where]] + inside[where]
    by = np.lexsort((place, group))
    group, where = group[by], where[by]
    again = np.zeros(len(where), dtype=bool)
    again[1:] = group[1:] == group[:-1]
    found = where[again]
    return found - piece[found]  # without the separators


def _shard_spans(rows: list[pa.RecordBatch], length: int) -> pa.RecordBatch:
    """(doc, ident, start, n): the bytes to remove, from a suffix array over some whole anchors."""
    table = pa.Table.from_batches(rows).combine_chunks()
    data, offsets = text_buffer(table.column("bytes"))
    doc, ident, start = (table.column(c).to_numpy() for c in ("doc", "ident", "start"))
    # documents in order, each with room for its places
    by = np.lexsort((ident, doc))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (doc[by][1:] != doc[by][:-1]) | (ident[by][1:] != ident[by][:-1])
    number = np.empty(len(by), dtype=np.int64)
    number[by] = np.cumsum(new)
    found = repeats_by_suffix_array(data, offsets, (number << 40) + start, length)
    piece = np.searchsorted(offsets, found, side="right") - 1
    at = start[piece] + found - offsets[piece]
    row, s, e = _union(piece, at, at + length)
    return _batch("doc ident start n", doc[row], ident[row], s, e - s)


def sorted_repeats(batches: Iterator[pa.RecordBatch], length: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """(doc, ident, start, n) of the repeats in pieces that are sorted by anchor and place.

    Strings routed one by one, whose anchor is their own hash, are compared with the first of their anchor: one that equals it is
    a repeat. Whatever is then alone in its anchor repeats nothing; all others go to suffix arrays.
    """
    held: list[pa.RecordBatch] = []  # whole anchors of the next array
    pending: list[pa.RecordBatch] = []  # what is left of the anchor at hand
    size, first = 0, None  # bytes held; the anchor at hand and its first string, if it has but one

    def solved(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Whole anchors, to arrays of about ``shard_bytes``."""
        nonlocal held, size
        anchor, (_, at) = part.column("anchor").to_numpy(), text_buffer(part.column("bytes"))
        ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
        begin = 0
        while begin < part.num_rows:
            k = int(np.searchsorted(at[ends], at[begin] + shard_bytes - size))
            end = int(ends[min(k, len(ends) - 1)])
            held.append(part.slice(begin, end - begin))
            size += int(at[end] - at[begin])
            begin = end
            if size >= shard_bytes:
                yield _shard_spans(held, length)
                held, size = [], 0

    def closed() -> Iterator[pa.RecordBatch]:
        nonlocal pending
        if sum(p.num_rows for p in pending) > 1:
            yield from solved(pa.Table.from_batches(pending).combine_chunks().to_batches()[0])
        pending = []

    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, alone = batch.column("anchor").to_numpy(), batch.column("n").to_numpy() == 1
        data, at = text_buffer(batch.column("bytes"))
        begins = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        counts = np.diff(np.append(begins, len(anchor)))
        goes_on = int(counts[0]) if first is not None and anchor[0] == first[0] else 0  # rows of the last batch's last anchor
        if not goes_on:
            yield from closed()
        head = np.repeat(begins, counts)
        alike = alone & alone[head] & (np.arange(len(anchor)) != head)
        if goes_on:
            alike[:goes_on] = alone[:goes_on] & (first[1] is not None)
        alike = np.flatnonzero(alike)
        inner = np.arange(length)
        theirs = data[at[head[alike]][:, None] + inner]
        if goes_on and first[1] is not None:
            theirs[alike < goes_on] = first[1]
        stays = np.ones(len(anchor), dtype=bool)
        stays[alike[(data[at[alike][:, None] + inner] == theirs).all(axis=1)]] = False
        if not stays.all():
            lost = batch.filter(pa.array(~stays))
            yield pa.RecordBatch.from_arrays([lost.column("doc"), lost.column("ident"), lost.column("start"),
                                              pa.array(np.full(lost.num_rows, length, np.int64))],
                                             names=["doc", "ident", "start", "n"])
        last = int(begins[-1])
        if goes_on and last:
            pending.append(batch.slice(0, goes_on).filter(pa.array(stays[:goes_on])))
            yield from closed()
        several = stays & np.repeat(np.add.reduceat(stays, begins, dtype=np.int64) > 1, counts)
        several[:goes_on] = several[last:] = False
        if several.any():
            yield from solved(batch.filter(pa.array(several)))
        pending.append(batch.slice(last).filter(pa.array(stays[last:])))
        if last or not goes_on:
            first = (anchor[-1], data[at[last]:at[last + 1]].copy() if alone[last] else None)
    yield from closed()
    if held:
        yield _shard_spans(held, length)


def shard_repeats(pieces: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(doc, ident, start, n): the bytes to remove, from suffix arrays over whole anchors, about ``shard_bytes`` each."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sorted_repeats(batches, length, shard_bytes)

    dealt = pieces.repartition("anchor").sortWithinPartitions("anchor", "doc", "ident", "start")
    return dealt.mapInArrow(work, f"{_PLACE}, n long")


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                     most_pieces: int = MOST_PIECES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, starts, ends, kept) of each document: removed byte spans, and the bytes that remain."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LEAST)).alias("doc"), F.xxhash64(whole).alias("ident"),
                       whole.alias("text"))
    marks = stage(folded_pieces(anchored_pieces(rows, length), length, most_pieces), "piece-marks")
    strings = piece_bytes(rows, marks.filter(F.col("kind") != REMOVE), length)
    spans = marks.filter(F.col("kind") == REMOVE).select("doc", "ident", "start", "n").unionByName(
        shard_repeats(strings, length, shard_bytes))
    lists = spans.groupBy("doc", "ident").agg(F.collect_list(F.struct("start", "n")).alias("gone"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, at = text_buffer(part.column("text"))
            gone = part.column("gone")
            count = np.nan_to_num(gone.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            row = np.repeat(np.arange(part.num_rows), count)
            flat = gone.flatten()
            start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
            row, start, end = _union(row, start, start + n)
            edge = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(edge, at[row] + start, 1)
            np.subtract.at(edge, at[row] + end, 1)
            stays = np.cumsum(edge[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(stays)])[at]
            spans = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))])
            size = np.diff(at)
            kept = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [
                None, pa.py_buffer(left), pa.py_buffer(np.ascontiguousarray(data[stays]))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([
                part.column("doc"), pa.array(size), pa.array(size - np.diff(left)),
                pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.array(start)),
                pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.array(end)), kept],
                names=["doc", "n_bytes", "n_removed", "starts", "ends", "kept"])

    done = rows.join(lists, ["doc", "ident"], "left").select("doc", "ident", "text", "gone").mapInArrow(
        work, "doc long, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept binary")
    return done.select(_id("doc").alias("doc_id"), "n_bytes", "n_removed", "starts", "ends", "kept")


def _id(column: str) -> Column:
    return F.when(F.col(column) != F.lit(_LEAST), F.col(column))
