"""N-gram Jaccard join by size: subsets for small sets, inverted lists for large ones, and the components of its links.

A document's set holds its distinct shingles of ``shingle`` words (runs other than white space, A-Z lower-cased), or the whole
sequence of fewer words. Two documents link if PERCENT of their union is common, that is if sets of sizes
s and t share o(s, t) = ceil(p (s + t) / (100 + p)) elements. Equal sets are one content, and contents are joined:

1. One pass over the texts stages each document's content and size, the elements of small sets (MOST_SMALL at most), and a
   count of all elements in a fixed number of cells. That count orders elements from rare to frequent; any
   order gives the same result.
2. The boundary: for each size up to MOST_SMALL, what its subsets would cost beside what scanning its lists would (rows
   written, entries met, elements shipped), over all sets of that size; the boundary is where the sum over sizes is least.
3. Light: a set of size s up to the boundary enumerates its subsets of the fixed sizes c = o(s, t), for each t up to
   the boundary that it can link with. Sets that share such a subset are linked if o(s, t) <= c, so nothing is left to verify, and in
   each subset's group linking all to the smallest set unites whatever is linked: o grows with both sizes.
4. Heavy: sets beyond the boundary, and those just below that may link with them, stand in the inverted lists of their s - ceil(p s) + 1
   rarest elements. In each list all are first paired with one member, where sizes and places allow a link; these pairs are verified
   exactly and linked contents united.
5. Lists that still hold several components are scanned. Those of SHORT members at most count, for members of different
   components, in how many lists they meet; o - ceil(p max(s, t)) + 1 common elements stand in the lists of both, so pairs that
   meet less often go, the others are verified exactly. Pairs of the longer lists stay inside tasks, block by block:
   those that could reach o by size, by place and by a bitmap of their elements (exact bounds) are verified there, and links that unite
   components alone come out. The largest component of a list is never compared with itself, so one foreign member costs one pass.

No pair is lost by the length of a list. Elements are told apart by 64 bit hashes, subsets by sums of hashes. The count of elements
(16 MB) and the bitmaps that thin shuffles (16 MB each) have fixed size; nothing else is broadcast.

Edge cases: null, empty and white texts have empty sets, no links and themselves as component; rows that repeat a doc_id
are documents of their own; a null doc_id counts as larger than any other in naming a component; ties do not arise; an empty table has
no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytework import MULTIPLIERS, U64, grams, lower_ascii, mix, runs, slices, span_hashes, text_buffer
from clickloom.llm.components import components
from clickloom.llm.filters import bitmap_of, in_bitmap
from clickloom.llm.frames import drop_staged, stage
from clickloom.llm.grouping import grouped, whole_groups

SHINGLE, PERCENT = 5, 80
#: Largest set whose subsets are ever considered.
MOST_SMALL = 24
#: Cells of the element count, in blocks for adding up.
CELLS, CELL_BLOCK = 1 << 22, 4096
#: An element counted more often than this may have a list too long for one task.
HOT = 1_000_000
#: Bits of the bitmap that bounds how much two sets can share.
SKETCH_BITS = 1024
#: Members of a list whose meetings are counted pair by pair.
SHORT = 32
#: Bits of the bitmap of elements that may be in several lists, in blocks for adding up.
REPEAT_BITS, REPEAT_BLOCK = 1 << 27, 1 << 15
#: Elements of the members compared at once.
BLOCK_ELEMENTS = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_SALT = U64(MULTIPLIERS[1])


def needed(s: int, t: int, percent: int = PERCENT) -> int:
    """Elements that sets of these sizes must share."""
    return -(-percent * (s + t) // (100 + percent))


def _needed(s: Column, t: Column, percent: int) -> Column:
    return F.ceil((s + t) * percent / (100 + percent) - 1e-9)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    return size - -(-percent * size // 100) + 1


class Sets:
    """The sets of the rows of a text column: elements row by row in ascending order."""

    def __init__(self, column: pa.Array, shingle: int):
        raw, at = text_buffer(column)
        data = lower_ascii(raw)
        starts, ends = runs(~_SPACE[data], at)
        words = span_hashes(data, starts, ends)
        first = np.searchsorted(starts, at)
        n = np.diff(first)
        row = np.repeat(np.arange(len(n)), n)
        h = grams(words, shingle)
        own = row[:len(h)]
        whole = first[own + 1] - np.arange(len(h)) >= shingle
        short = np.flatnonzero((n > 0) & (n < shingle))
        elements = np.concatenate([h[whole], span_hashes(words, first[:-1][short], first[1:][short])])
        row = np.concatenate([own[whole], short])
        by = np.lexsort((elements, row))
        elements, row = elements[by], row[by]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (elements[1:] != elements[:-1]) | (row[1:] != row[:-1])
        self.elements, self.row = elements[new], row[new]
        self.size = np.bincount(self.row, minlength=len(n))
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        total = np.zeros(len(self.elements) + 1, dtype=U64)
        np.cumsum(mix(self.elements), out=total[1:])
        self.content = mix(total[self.first[1:]] - total[self.first[:-1]] + self.size.astype(U64) * _SALT)

    def once(self, rows: np.ndarray) -> np.ndarray:
        """One row of each content among these rows."""
        _, first = np.unique(self.content[rows], return_index=True)
        return rows[np.sort(first)]

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Elements of some rows and their offsets."""
        size = self.size[rows]
        at = np.concatenate([[0], np.cumsum(size)])
        return self.elements[np.repeat(self.first[rows] - at[:-1], size) + np.arange(at[-1])], at


def _cell(elements: np.ndarray) -> np.ndarray:
    return (mix(elements ^ _SALT) & U64(CELLS - 1)).astype(np.int64)


def _narrow(counts: np.ndarray) -> bytes:
    """A block of counts in as few bytes each as hold the largest; the length tells how many."""
    most = counts.max()
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes()


def _widened(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(packed) // CELL_BLOCK]).astype(np.int64)


_FACTS = "doc long, content long, size long, small array<long>, cells int, counts binary"
_FACTS_ARROW = pa.schema([("doc", pa.int64()), ("content", pa.int64()), ("size", pa.int64()), ("small", pa.list_(pa.int64())),
                          ("cells", pa.int32()), ("counts", pa.binary())])


def facts(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """A row for each document, and for each task its counts of elements, a row for each block of cells."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for part in slices(batches, "text"):
            sets = Sets(part.column("text"), shingle)
            counts += np.bincount(_cell(sets.of(sets.once(np.flatnonzero(sets.size > 0)))[0]), minlength=CELLS)
            some = (sets.size > 0) & (sets.size <= MOST_SMALL)
            elements, at = sets.of(np.flatnonzero(some))
            ends = np.concatenate([[0], np.cumsum(np.where(some, sets.size, 0))])
            small = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(elements.view(np.int64)))
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([
                part.column("doc"), pa.array(sets.content.view(np.int64), mask=sets.size == 0), pa.array(sets.size), small,
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_FACTS_ARROW)
        if counts.any():
            packed = [_narrow(c) for c in np.minimum(counts, (1 << 32) - 1).reshape(-1, CELL_BLOCK)]
            n = len(packed)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())),
                pa.array(np.arange(n, dtype=np.int32)), pa.array(packed, pa.binary())], schema=_FACTS_ARROW)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, _FACTS)


def element_counts(found: DataFrame) -> np.ndarray:
    """All tasks' counts added up: CELLS numbers come to the driver."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for cells, counts in zip(batch.column("cells").to_pylist(), batch.column("counts"), strict=True):
                sums[cells] = sums.get(cells, 0) + _widened(counts.as_py())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([_narrow(np.minimum(v, (1 << 32) - 1)) for v in sums.values()], pa.binary())], names=["cells", "counts"])

    out = np.zeros((CELLS // CELL_BLOCK, CELL_BLOCK), dtype=np.int64)
    for r in found.filter("cells is not null").select("cells", "counts").repartition("cells").mapInArrow(
            work, "cells int, counts binary").collect():
        out[r["cells"]] += _widened(bytes(r["counts"]))
    return np.minimum(out.ravel(), (1 << 32) - 1).astype(np.uint32)


def subset_sizes(s: int, limit: int, percent: int) -> list[int]:
    """Sizes of the subsets a set of size s enumerates to meet all sets it can link with, up to the limit in size."""
    partners = range(-(-percent * s // 100), min(limit, 100 * s // percent) + 1)
    return sorted({needed(s, t, percent) for t in partners})


def boundary(small: DataFrame, counts: np.ndarray, percent: int) -> int:
    """The largest size whose sets enumerate subsets: where the cost of both ways together is least.

    Lists are as long as the cells of their elements tell, without what other elements add to a cell on average.
    """
    noise = float(counts.mean())
    shared = small.sparkSession.sparkContext.broadcast(counts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, heavy = np.zeros(MOST_SMALL + 1, np.int64), np.zeros(MOST_SMALL + 1)
        for batch in batches:
            for elements in batch.column("small").to_pylist():
                s = len(elements)
                held = np.sort(shared.value[_cell(np.array(elements, dtype=np.int64).view(U64))])
                p = s - -(-percent * s // 100) + 1
                met = np.maximum(held[:p] - noise - 1, 0).sum()
                n[s] += 1
                heavy[s] += p + met + (s if met else 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(MOST_SMALL + 1)), pa.array(n), pa.array(heavy)], names=["s", "n", "heavy"])

    found = small.select("small").mapInArrow(work, "s long, n long, heavy double").groupBy("s").agg(
        F.sum("n").alias("n"), F.sum("heavy").alias("heavy")).collect()
    of = {r["s"]: r for r in found}
    light = [of[s]["n"] * sum(comb(s, c) for c in subset_sizes(s, MOST_SMALL, percent)) if s in of else 0 for s in range(1, MOST_SMALL + 1)]
    heavy = [of[s]["heavy"] if s in of else 0 for s in range(1, MOST_SMALL + 1)]
    totals = [sum(light[:x]) + sum(heavy[x:]) for x in range(MOST_SMALL + 1)]
    return int(np.argmin(totals))


def subset_links(small: DataFrame, limit: int, percent: int) -> DataFrame:
    """(a, b): links that unite all sets up to the limit in size that are linked."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, content = batch.column("small"), batch.column("content").to_numpy()
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            for s in np.unique(size).tolist():
                rows = np.flatnonzero(size == s)
                hashed = mix(mix(lists.take(pa.array(rows)).flatten().to_numpy().view(U64)).reshape(len(rows), s))
                total = hashed.sum(axis=1, dtype=U64)
                for c in subset_sizes(s, limit, percent):
                    gone = np.array(list(combinations(range(s), s - c)), dtype=np.int64).reshape(comb(s, c), s - c)
                    step = max(1, (1 << 20) // gone.size) if gone.size else len(rows)
                    for start in range(0, len(rows), step):
                        some = slice(start, start + step)
                        keys = total[some, None] - hashed[some][:, gone].sum(axis=2, dtype=U64)
                        keys = mix(keys + mix(np.array([c], dtype=U64))).view(np.int64)
                        n = keys.size
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.ravel()), pa.array(np.full(n, c)), pa.array(np.full(n, s)),
                             pa.array(np.repeat(content[rows[some]], keys.shape[1]))], names=["subset", "c", "size", "content"])

    subsets = small.select("content", "small").mapInArrow(work, "subset long, c long, size long, content long")
    smallest = subsets.groupBy("subset").agg(F.min(F.struct("size", "content")).alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    near = _needed(F.col("m.size"), F.col("size"), percent) <= F.col("c")
    return subsets.join(smallest, "subset").filter((F.col("content") != F.col("m.content")) & near).select(
        F.col("content").alias("a"), F.col("m.content").alias("b")).distinct()


def rare_elements(docs: DataFrame, text: str, shingle: int, percent: int, least: int, counts: np.ndarray) -> DataFrame:
    """(content, size, rare, hot, bits) of the sets of ``least`` elements and more: the rarest elements in order, which of them are hot, the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = Sets(part.column("text"), shingle)
            rows = sets.once(np.flatnonzero(sets.size >= max(1, least)))
            if not len(rows):
                continue
            elements, at = sets.of(rows)
            bits = _bits(elements, at)
            row = np.repeat(np.arange(len(rows)), np.diff(at))
            held = shared.value[_cell(elements)]
            by = np.lexsort((elements, held, row))
            elements, held = elements[by], held[by]
            place = np.arange(len(elements)) - at[row]
            p = prefix_length(sets.size[rows], percent)
            some, ends = place < p[row], pa.array(np.concatenate([[0], np.cumsum(p)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.content[rows].view(np.int64)), pa.array(sets.size[rows]),
                 pa.ListArray.from_arrays(ends, pa.array(elements[some].view(np.int64))),
                 pa.ListArray.from_arrays(ends, pa.array(held[some] > HOT)), bits], names=["content", "size", "rare", "hot", "bits"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        work, "content long, size long, rare array<long>, hot array<boolean>, bits binary")


def _bits(elements: np.ndarray, at: np.ndarray) -> pa.Array:
    """A bitmap of each row's elements: a bit is set if an odd number of them falls on it, so two rows differ in as many elements at least."""
    n = len(at) - 1
    bit = (mix(elements) % U64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(n), np.diff(at)) * SKETCH_BITS + bit, minlength=n * SKETCH_BITS) & 1
    return pa.array([b.tobytes() for b in np.packbits(odd.reshape(n, SKETCH_BITS).astype(np.uint8), axis=1)], pa.binary())


def whole_sets(docs: DataFrame, text: str, shingle: int, bitmap: np.ndarray) -> DataFrame:
    """(content, elements) of the contents in the bitmap, and of some others."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = Sets(part.column("text"), shingle)
            rows = sets.once(np.flatnonzero((sets.size > 0) & in_bitmap(shared.value, sets.content)))
            if not len(rows):
                continue
            elements, at = sets.of(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.content[rows].view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(elements.view(np.int64)))], names=["content", "elements"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(work, "content long, elements array<long>")


def sets_of(docs: DataFrame, text: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """The sets of the contents in a table, each once, dealt by content; joins on it find them where they lie."""
    return whole_sets(docs, text, shingle, bitmap_of(wanted, F.col("content"))).repartition("content").dropDuplicates(["content"])


def likely(pairs: DataFrame, rare: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose sizes and bitmaps allow a link."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t = batch.column("s").to_numpy(), batch.column("t").to_numpy()
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(len(s), -1) for c in ("x", "y"))
            differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            need = -(-percent * (s + t) // (100 + percent))
            yield batch.filter(pa.array((s + t - differ) // 2 >= need)).select(["a", "b"])

    bits = rare.select("content", "size", "bits").dropDuplicates(["content"])
    x = bits.select(F.col("content").alias("a"), F.col("size").alias("s"), F.col("bits").alias("x"))
    y = bits.select(F.col("content").alias("b"), F.col("size").alias("t"), F.col("bits").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "s", "t", "x", "y").mapInArrow(work, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that link, by exact count."""
    x = sets.select(F.col("content").alias("a"), F.col("elements").alias("x"))
    y = sets.select(F.col("content").alias("b"), F.col("elements").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").filter(
        common * 100 >= (F.size("x") + F.size("y") - common) * percent).select("a", "b")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


class _Cell:
    """Members of one list that one task compares: side 0 with side 1, or side 2 with itself."""

    def __init__(self, table: pa.Table):
        self.content, self.root, self.size, self.place, self.side = (
            table.column(c).to_numpy() for c in ("content", "root", "size", "place", "side"))
        self.bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(self.content), SKETCH_BITS // 64)
        self.elements = table.column("elements").combine_chunks()

    def set(self, p: int) -> np.ndarray:
        return self.elements[p].values.to_numpy().view(U64)

    def links(self, percent: int, limit: int) -> list[tuple[int, int]]:
        """Links that unite components, as many as do."""
        out = []
        _, part = np.unique(self.root, return_inverse=True)
        other = np.flatnonzero(self.side > 0)
        for p in np.flatnonzero(self.side != 1).tolist():
            mates = other[part[other] != part[p]]
            if self.side[p] == 2:
                mates = mates[self.content[mates] > self.content[p]]
            s, t = self.size[p], self.size[mates]
            need = -(-percent * (s + t) // (100 + percent))
            i, j = self.place[p], self.place[mates]
            most = np.minimum(i, j) + 1 + np.minimum(s - i, t - j) - 1
            could = (np.minimum(np.minimum(s, t), most) >= need) & (np.maximum(s, t) > limit)
            mates, need = mates[could], need[could]
            differ = np.bitwise_count(self.bits[mates] ^ self.bits[p]).sum(axis=1, dtype=np.int64)
            for q in mates[(s + self.size[mates] - differ) // 2 >= need].tolist():
                if part[q] != part[p]:
                    common = _common(self.set(p), self.set(q))
                    if 100 * common >= percent * (s + self.size[q] - common):
                        out.append((min(self.content[p], self.content[q]), max(self.content[p], self.content[q])))
                        part[part == part[q]] = part[p]
        return out


def _blocks(elements: str) -> Column:
    return F.ceil(F.coalesce(F.col(elements), F.lit(0)) / BLOCK_ELEMENTS).cast("int")


def dealt(members: DataFrame) -> DataFrame:
    """Members of the lists that hold several components, once for each cell they are compared in.

    Those outside the list's largest component are its foreign members. Blocks of them meet each other and the blocks of
    the rest; the rest never meets itself.
    """
    parts = members.groupBy("element", "root").agg(F.sum("size").alias("held"), F.max("index").alias("index"))
    lists = parts.groupBy("element").agg(
        F.count(F.lit(1)).alias("n"), F.max("index").alias("any"), F.sum("held").alias("all"),
        F.max(F.struct("held", "root")).alias("most")).filter("n > 1 and any").select(
            "element", F.col("most.root").alias("main"), (F.col("all") - F.col("most.held")).alias("foreign"), F.col("most.held").alias("own"))
    placed = members.join(stage(lists, "split-lists"), "element").withColumn("f", _blocks("foreign")).withColumn("g", _blocks("own"))
    foreign = F.col("root") != F.col("main")
    mine = F.pmod(F.xxhash64("content"), F.when(foreign, F.col("f")).otherwise(F.col("g"))).cast("int")
    whole = placed.withColumn("mine", mine)
    with_rest = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda y: F.struct(
        F.lit(0).alias("kind"), F.col("mine").alias("x"), y.alias("y"), F.lit(0).alias("side")))
    with_foreign = F.transform(F.sequence(F.lit(0), F.col("f") - 1), lambda y: F.struct(
        F.lit(1).alias("kind"), F.least("mine", y).alias("x"), F.greatest("mine", y).alias("y"),
        F.when(y == F.col("mine"), 2).otherwise((F.col("mine") > y).cast("int")).alias("side")))
    rest = F.transform(F.sequence(F.lit(0), F.col("f") - 1), lambda x: F.struct(
        F.lit(0).alias("kind"), x.alias("x"), F.col("mine").alias("y"), F.lit(1).alias("side")))
    cells = F.explode(F.when(foreign, F.concat(with_rest, with_foreign)).otherwise(rest)).alias("cell")
    return whole.select("element", "content", "root", "size", "place", cells).select("element", "cell.*", "content", "root", "size", "place")


def links_apart(apart: DataFrame, sets: DataFrame, rare: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b): verified links between the members dealt to a cell that are in different components."""
    keys = ["element", "kind", "x", "y"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys):
            out = _Cell(group).links(percent, limit) if group.num_rows > 1 else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, dtype=np.int64)) for x in zip(*out, strict=True)], names=["a", "b"])

    bits = rare.select("content", "bits").dropDuplicates(["content"])
    shipped = apart.join(bits, "content").join(sets, "content").repartition(*keys).sortWithinPartitions(*keys)
    return shipped.mapInArrow(work, "a long, b long")


def _repeat_cell(elements: np.ndarray) -> np.ndarray:
    return (mix(elements + _SALT) & U64(REPEAT_BITS - 1)).astype(np.uint32)


def repeated(rare: DataFrame) -> np.ndarray:
    """A bitmap of the cells that several of the listed elements fall in: all elements of several lists, and some others."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_repeat_cell(b.column("rare").flatten().to_numpy().view(U64)) for b in batches if b.num_rows]
        if found:
            cell = np.sort(np.concatenate(found))
            block, first = np.unique(cell // REPEAT_BLOCK, return_index=True)
            parts = np.split((cell % REPEAT_BLOCK).astype(np.uint16), first[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.astype(np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "cells"])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = None, np.zeros(REPEAT_BLOCK, np.int64)

        def row() -> pa.RecordBatch:
            bits = np.packbits(counts > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for mine, some in zip(batch.column("block").to_pylist(), batch.column("cells"), strict=True):
                if mine != block:
                    if block is not None:
                        yield row()
                    block, counts = mine, np.zeros(REPEAT_BLOCK, np.int64)
                counts = counts + np.bincount(np.frombuffer(some.as_buffer(), np.uint16), minlength=REPEAT_BLOCK)
        if block is not None:
            yield row()

    out = np.zeros((REPEAT_BITS // REPEAT_BLOCK, REPEAT_BLOCK // 8), np.uint8)
    blocks = rare.select("rare").mapInArrow(cells, "block int, cells binary").repartition("block").sortWithinPartitions("block")
    for r in blocks.mapInArrow(marked, "block int, bits binary").collect():
        out[r["block"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.ravel()


def _listed(rare: DataFrame, percent: int) -> DataFrame:
    """(element, content, size, place, index, n, c_content, c_size, c_place, c_index): the entries of lists with several contents.

    ``index``: an element among the first s - o(s, s) + 1; of two sets that link, the smaller has one of the common ones there.
    ``n``: members of the list; ``c_``: its first content.
    """
    shared = rare.sparkSession.sparkContext.broadcast(repeated(rare))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("rare")
            length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            elements = lists.flatten().to_numpy().view(U64)
            row = np.repeat(np.arange(len(length)), length)
            place = np.arange(len(elements)) - np.repeat(np.cumsum(length) - length, length)
            cell = _repeat_cell(elements)
            some = np.flatnonzero(shared.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1)
            at = (batch.column("size").to_numpy()[row[some]] << 32) + place[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(elements[some].view(np.int64)), batch.column("content").take(pa.array(row[some])), pa.array(at),
                 batch.column("hot").flatten().take(pa.array(some))], names=["element", "content", "at", "hot"])

    rows = rare.select("content", "size", "rare", "hot").mapInArrow(entries, "element long, content long, at long, hot boolean")
    # lists of a size that one task holds: one shuffle by element serves all steps; the others are summed up before theirs
    tame = rows.filter("not hot").drop("hot").repartition("element").dropDuplicates(["element", "content"])
    hot = rows.filter("hot").drop("hot").dropDuplicates(["element", "content"])
    return _with_first(tame, percent).unionByName(_with_first(hot, percent))


def _with_first(entries: DataFrame, percent: int) -> DataFrame:
    """Entries of lists with several contents, beside the list's first one and its length."""
    lists = entries.groupBy("element").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("content", "at")).alias("c")).filter("n > 1")

    def told(content: str, at: str, name: str) -> list[Column]:
        size, place = F.shiftright(at, 32), F.col(at).bitwiseAND(F.lit((1 << 32) - 1))
        index = place <= size - _needed(size, size, percent)
        return [F.col(content).alias(f"{name}content"), size.alias(f"{name}size"), place.alias(f"{name}place"), index.alias(f"{name}index")]

    return entries.join(lists, "element").select(
        "element", "content", "at", "n", F.col("c.content").alias("first"), F.col("c.at").alias("first_at")).select(
            "element", "n", *told("content", "at", ""), *told("first", "first_at", "c_"))


def met_pairs(short: DataFrame, held: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b): members of different components that meet often enough in lists to link.

    ``short``: the rows of short lists; ``held``: (content, longs), in how many longer lists a content stands, which count in full.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, end in whole_groups(batches, "element"):
            content, root, size, place = (rows.column(c).to_numpy() for c in ("content", "root", "size", "place"))
            later = end - np.arange(len(end)) - 1
            i = np.repeat(np.arange(len(end)), later)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
            s, t = size[i], size[j]
            need = -(-percent * (s + t) // (100 + percent))
            most = np.minimum(place[i], place[j]) + np.minimum(s - place[i], t - place[j])
            some = (root[i] != root[j]) & (np.minimum(np.minimum(s, t), most) >= need) & (np.maximum(s, t) > limit)
            least = need - -(-percent * np.maximum(s, t) // 100) + 1
            i, j, least = i[some], j[some], least[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(content[i], content[j])), pa.array(np.maximum(content[i], content[j])), pa.array(least)],
                names=["a", "b", "least"])

    rows = short.select("element", "content", "root", "size", "place").repartition("element").sortWithinPartitions("element")
    pairs = rows.mapInArrow(work, "a long, b long, least long").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("met"), F.first("least").alias("least"))
    longs = [held.select(F.col("content").alias(c), F.col("longs").alias(f"longs_{c}")) for c in ("a", "b")]
    further = F.least(*(F.coalesce(f"longs_{c}", F.lit(0)) for c in ("a", "b")))
    return pairs.join(longs[0], "a", "left").join(longs[1], "b", "left").filter(F.col("met") + further >= F.col("least")).select("a", "b")


def star_pairs(members: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b): each member with the first content of its lists, where sizes and places allow a link."""
    s, t = F.col("size"), F.col("c_size")
    smaller = F.when(s < t, F.col("index")).when(s > t, F.col("c_index")).otherwise(F.col("index") | F.col("c_index"))
    need = _needed(s, t, percent)
    i, j = F.col("place"), F.col("c_place")
    most = F.least(i, j) + 1 + F.least(s - i, t - j) - 1
    return members.filter((F.col("content") != F.col("c_content")) & smaller & (F.least(s, t, most) >= need) & (
        F.greatest(s, t) > limit)).select(F.col("content").alias("a"), F.col("c_content").alias("b")).distinct()


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       percent: int = PERCENT, limit: int | None = None) -> DataFrame:
    """(doc, n_shingles, content, component_id) of every document; ``limit`` sets the boundary instead of its cost."""
    if not 50 <= percent <= 100:
        raise ValueError("the similarity is 50 to 100 per cent")
    found = stage(facts(docs, doc_id, text, shingle), "sets")
    counts = element_counts(found)
    told = found.filter("cells is null")
    contents = stage(told.filter("content is not null").groupBy("content").agg(
        F.min(F.struct(F.col("doc").isNull().alias("none"), "doc")).alias("least"), F.first("size").alias("size"),
        F.first("small").alias("small")), "contents")
    small = contents.filter(F.col("size") <= MOST_SMALL).select("content", "size", "small")
    if limit is None:
        limit = boundary(small, counts, percent)
    light = stage(subset_links(small.filter(F.col("size") <= limit), limit, percent), "subset-links")

    rare = stage(rare_elements(docs, text, shingle, percent, -(-percent * (limit + 1) // 100), counts), "rare-elements")
    members = stage(_listed(rare, percent), "members")
    star = stage(likely(star_pairs(members, percent, limit), rare, percent), "star-pairs")
    in_star = star.select(F.col("a").alias("content")).unionByName(star.select(F.col("b").alias("content")))
    links = stage(light.unionByName(verified(star, sets_of(docs, text, shingle, in_star), percent)), "links")
    roots = components(links)

    rooted = members.select("element", "content", "size", "place", "index", "n").join(
        roots.withColumnRenamed("node", "content"), "content", "left").withColumn("root", F.coalesce("root", "content"))
    split = rooted.groupBy("element").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("element")
    rooted = stage(rooted.join(split, "element"), "split-lists")
    short, long = rooted.filter(F.col("n") <= SHORT), rooted.filter(F.col("n") > SHORT)
    held = stage(long.groupBy("content").agg(F.count(F.lit(1)).alias("longs")), "long-lists")
    pairs = stage(likely(met_pairs(short, held, percent, limit), rare, percent), "met-pairs")
    in_pairs = pairs.select(F.col("a").alias("content")).unionByName(pairs.select(F.col("b").alias("content")))
    sets = sets_of(docs, text, shingle, in_pairs.unionByName(held.select("content")))
    more = stage(verified(pairs, sets, percent).unionByName(links_apart(dealt(long), sets, rare, percent, limit)), "more-links")
    drop_staged(rare)
    roots = components(links.unionByName(more))

    named = contents.select("content", "least").join(roots.withColumnRenamed("node", "content"), "content", "left").withColumn(
        "root", F.coalesce("root", "content"))
    classes = stage(named.groupBy("root").agg(F.min("least").alias("first")), "classes")
    by_content = stage(named.join(classes, "root").select("content", F.col("first.doc").alias("component_id")), "component-of-content")
    return told.select("doc", "size", "content").join(by_content, "content", "left").select(
        "doc", F.col("size").alias("n_shingles"), "content",
        F.when(F.col("content").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id"))
