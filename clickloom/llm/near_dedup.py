"""Near-duplicate classes: DartMinHash signatures, banded joining, exact verification, components.

Documents are bags of five-word shingles (decontamination's words); two are linked if the weighted
Jaccard similarity of their bags, each shingle weighing its count, is 0.8 or more. A class is a connected
component of links.

1. Documents of equal words are one content; from here on only contents move.
2. Signatures of ``bands * rows`` coordinates are cut into bands; contents equal in a band share a bucket.
   At similarity 0.8 two share none of 20 bands of 4 with a probability of (1 - 0.8^4)^20 = 2.6e-5; this is all that can be missed.
3. In each bucket every content is paired with one member, the one that shares the most buckets
   with others, so a bucket of n gives n pairs and mostly the same ones in all bands. Pairs are verified
   exactly and linked contents united.
4. What 3. leaves apart is compared within its buckets, in blocks of bounded size. Members of a bucket's largest component
   need no comparison among themselves: they meet the others alone, so a bucket of n with few others costs n, not n^2. Pairs of different
   components are screened by an upper bound of their overlap, from sizes and histograms of their shingles, which no
   similar pair fails, and verified exactly. Only links that unite components are written out.

So no pair that shares a bucket is left out, and all pairs of a bucket are never written out. A center that many are paired with is
repeated, so that several tasks verify its pairs. The shingles needed for verification are computed by a second pass
over the texts; a bitmap of fixed size of the contents in question thins it. Staged tables are removed when the classes are known.

Edge cases: null, empty and word-less texts are in no content and a class of their own; rows that repeat a doc_id
are documents like others (of equal ids the text with the smaller hash comes first); null doc_ids count as larger than any other for naming a class; an empty table has no rows; further columns are
not read (``near_duplicates``) or kept (``one_of_each``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.bytework import MULTIPLIERS, U64, Words, mix, slices
from clickloom.llm.components import components
from clickloom.llm.dart_minhash import contents, shingle_cells, signatures
from clickloom.llm.filters import bitmap_of, in_bitmap
from clickloom.llm.frames import drop_staged, fresh, stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
#: Members of a bucket that are compared at once.
BLOCK = 2048
#: Pairs of one center that a task verifies.
PAIRS_PER_TASK = 16384
#: Bins of the histograms that bound an overlap.
BINS = 512


def row_key(doc_id: str, text: str) -> Column:
    """One number for rows of equal id and text."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))


def content_signatures(docs: DataFrame, doc_id: str, text: str, bands: int, rows: int, shingle: int) -> DataFrame:
    """(doc, row_key, content, bands, coords) of each document; content is null where there are no words."""
    k = bands * rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column("text"))
            cells, first = shingle_cells(words, shingle)
            won = signatures(cells, first, k)
            keys = np.zeros((len(won), bands), dtype=U64)
            for r in range(rows):
                keys = keys * U64(MULTIPLIERS[0]) + won[:, r::rows]
            keys = mix(keys + np.arange(bands, dtype=U64) * U64(MULTIPLIERS[1])).view(np.int64)
            coords = np.ascontiguousarray((won >> U64(48)).astype(np.uint16))
            yield pa.RecordBatch.from_arrays([
                part.column("doc"), part.column("row_key"),
                pa.array(contents(words).view(np.int64), mask=np.diff(words.first) == 0),
                pa.ListArray.from_arrays(pa.array(np.arange(len(won) + 1) * bands, pa.int32()), pa.array(keys.ravel())),
                pa.array([c.tobytes() for c in coords], pa.binary()),
            ], names=["doc", "row_key", "content", "bands", "coords"])

    rows_in = docs.select(F.col(doc_id).cast("long").alias("doc"), row_key(doc_id, text).alias("row_key"),
                          F.col(text).cast("string").alias("text"))
    return rows_in.mapInArrow(work, "doc long, row_key long, content long, bands array<long>, coords binary")


def content_cells(docs: DataFrame, text: str, shingle: int, bitmap: np.ndarray) -> DataFrame:
    """(content, cells): the shingle cells of the contents in the bitmap, and of some others."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for part in slices(batches, "text"):
            words = Words(part.column("text"))
            content = contents(words)
            wanted = in_bitmap(bits, content) & (np.diff(words.first) > 0)
            _, once = np.unique(content, return_index=True)
            rows = np.sort(once[wanted[once]])
            if not len(rows):
                continue
            cells, first = shingle_cells(Words(part.column("text").take(pa.array(rows))), shingle)
            yield pa.RecordBatch.from_arrays([
                pa.array(content[rows].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(cells.view(np.int64))),
            ], names=["content", "cells"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(work, "content long, cells array<long>")


def verified(pairs: DataFrame, cells: DataFrame, similarity: float, per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """The (a, b) pairs whose bags are similar enough, by exact count; a ``b`` of many pairs is repeated for each ``per_task`` of them."""
    pieces = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / per_task).cast("int").alias("pieces"))
    x = cells.select(F.col("content").alias("a"), F.col("cells").alias("x"))
    y = cells.select(F.col("content").alias("b"), F.col("cells").alias("y")).join(pieces, "b").select(
        "b", "y", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    dealt = pairs.join(pieces, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("pieces")).cast("int").alias("piece"))
    n, m, both = F.size("x"), F.size("y"), F.size(F.array_intersect("x", "y"))
    near = (F.least(n, m) / F.greatest(n, m) >= similarity) & (both / (n + m - both) >= similarity)
    return dealt.join(x, "a").join(y, ["b", "piece"]).filter(near).select("a", "b")


def split_buckets(rooted: DataFrame) -> DataFrame:
    """(bucket, main, most) of the buckets whose members are in several components: the largest of these, and its members."""
    found = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("top"))
    return found.filter("roots > 1").select("bucket", F.col("top.root").alias("main"), F.col("top.n").alias("most"))


def deal(members: DataFrame, block: int) -> DataFrame:
    """Members of split buckets, each in the cells (bucket, i, j) of blocks that it is compared in; ``own``: its block.

    The members out of the largest component are in blocks that meet each other and all blocks of that component; these do not
    meet each other. A cell holds two blocks.
    """
    # as many blocks as it takes, of those outside of the largest component and of those inside
    outer, inner = F.ceil((F.col("size") - F.col("most")) / block).cast("int"), F.ceil(F.col("most") / block).cast("int")
    inside, number = F.col("root") == F.col("main"), F.xxhash64("content")
    own = F.when(inside, outer + F.pmod(number, inner)).otherwise(F.pmod(number, outer)).cast("int")
    others = F.sequence(F.lit(0), F.when(inside, outer).otherwise(outer + inner) - 1)
    return members.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "content", "root",
        "bands", "coords", "cells")


def links_apart(members: DataFrame, similarity: float, block: int) -> DataFrame:
    """(a, b): verified links between members of a bucket that lie in different components, as many as unite them.

    ``members``: bucket, size, content, root, main, most, bands, coords, cells. Pairs are looked at in their first
    common band only, screened by their sizes and histograms, and verified, those whose coordinates agree most first, unless
    links found before have united them. Pairs stay inside the task; links alone come out.
    """
    dealt = deal(members, block)

    def compare(rows: list[pa.Table], out: list) -> None:
        group = pa.concat_tables(rows)
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        content, root, own = (group.column(c).to_numpy() for c in ("content", "root", "own"))
        if len(content) < 2:
            return
        coords = np.frombuffer(b"".join(group.column("coords").to_pylist()), dtype=np.uint16).reshape(len(content), -1)
        keys = np.stack(group.column("bands").to_numpy())
        cells = group.column("cells").combine_chunks()
        band = int(np.flatnonzero(keys[0] == group.column("bucket")[0].as_py())[0])
        side = np.flatnonzero(own == j)
        size, bins = _histograms(cells)
        _, part = np.unique(root, return_inverse=True)  # components, as links unite them
        bags: dict[int, np.ndarray] = {}

        def bag(p: int) -> np.ndarray:
            if p not in bags:
                bags[p] = np.sort(cells[p].values.to_numpy())
            return bags[p]

        for p in np.flatnonzero(own == i).tolist():
            mates = side[part[side] != part[p]]
            if i == j:
                mates = mates[content[mates] > content[p]]
            if not len(mates):
                continue
            mates = mates[np.minimum(size[mates], size[p]) >= similarity * np.maximum(size[mates], size[p]) - 1]
            if band:
                mates = mates[~(keys[mates, :band] == keys[p, :band]).any(axis=1)]
            most = np.minimum(bins[mates], bins[p]).sum(axis=1)
            mates = mates[most >= similarity * (size[mates] + size[p] - most) - 1]
            agree = (coords[mates] == coords[p]).sum(axis=1)
            for q in mates[np.argsort(-agree, kind="stable")].tolist():
                if part[q] != part[p] and _alike(bag(p), bag(q), similarity):
                    out.append((min(content[p], content[q]), max(content[p], content[q])))
                    part[part == part[q]] = part[p]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table, out = pa.Table.from_batches([batch]), []
            three = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")])
            cuts = np.flatnonzero(np.append(True, (three[:, 1:] != three[:, :-1]).any(axis=0)))
            for s, e in zip(cuts, np.append(cuts[1:], batch.num_rows), strict=True):
                mine = tuple(three[:, s].tolist())
                if held and mine != key:
                    compare(held, out)
                    held = []
                key = mine
                held.append(table.slice(s, e - s))
            yield _pairs(out)
        if held:
            out = []
            compare(held, out)
            yield _pairs(out)

    dealt = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInArrow(work, "a long, b long")


def _histograms(cells: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The size of each bag and how many of its cells fall in each bin: two bags share no more than the smaller counts add up to."""
    size = cells.value_lengths().to_numpy().astype(np.int64)
    key = (cells.flatten().to_numpy() & (BINS - 1)) + np.repeat(np.arange(len(size)) * BINS, size)
    return size, np.bincount(key, minlength=len(size) * BINS).astype(np.int32).reshape(-1, BINS)


def _alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted bags are similar enough."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) < similarity * len(b) - 1:
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both) >= similarity


def _pairs(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array([o[n] for o in out], dtype=np.int64)) for n in (0, 1)], names=["a", "b"])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc, row_key, content, class_id, keeper) of every document.

    ``class_id`` is the smallest doc_id of its class, ``keeper`` the row_key of that document.
    """
    signed = stage(content_signatures(docs, doc_id, text, bands, rows, shingle), "signatures")
    unique = stage(signed.filter("content is not null").groupBy("content").agg(
        F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "row_key")).alias("least"), F.first("bands").alias("bands"), F.first("coords").alias("coords")), "contents")

    placed = unique.select("content", F.explode("bands").alias("bucket"))
    sizes = stage(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "bucket-sizes")
    members = stage(placed.join(sizes, "bucket"), "members")
    known = stage(members.groupBy("content").agg(F.sum("size").alias("met")), "popularity")
    central = members.join(known, "content").groupBy("bucket").agg(
        F.max(F.struct("met", "content")).alias("top")).select("bucket", F.col("top.content").alias("center"))
    central = stage(central, "centers")
    star = stage(members.join(central, "bucket").filter("content <> center").select(
        F.col("content").alias("a"), F.col("center").alias("b")).distinct(), "star-pairs")
    cells = stage(content_cells(docs, text, shingle, bitmap_of(known, F.col("content")))
                  .join(known.select("content"), "content", "left_semi").dropDuplicates(["content"]), "cells")
    links = stage(verified(star, cells, similarity), "links")
    roots = components(links)

    rooted = members.join(roots.withColumnRenamed("node", "content"), "content", "left").withColumn(
        "root", F.coalesce("root", "content"))
    split = stage(split_buckets(rooted), "split-buckets")
    apart = rooted.join(split, "bucket").join(unique.select("content", "bands", "coords"), "content").join(cells, "content")
    more = stage(links_apart(apart, similarity, block), "more-links")
    roots = components(links.unionByName(more))

    named = unique.select("content", "least").join(roots.withColumnRenamed("node", "content"), "content", "left").withColumn(
        "root", F.coalesce("root", "content"))
    classes = stage(named.groupBy("root").agg(F.min("least").alias("first")), "classes")
    by_content = stage(named.join(classes, "root").select(
        "content", F.col("first.doc").alias("class_id"), F.col("first.row_key").alias("keeper")), "class-of-content")
    for table in (unique, sizes, members, known, central, star, cells, links, split, more, classes):
        drop_staged(table)
    alone = F.col("content").isNull()
    return signed.select("doc", "row_key", "content").join(by_content, "content", "left").select(
        "doc", "row_key", "content", F.when(alone, F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("row_key")).otherwise(F.col("keeper")).alias("keeper"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, all columns, without the further ones of each class: the smallest doc_id stays.

    Of rows that repeat that document one stays. Documents without words all stay.
    """
    found = near_duplicates(docs, doc_id, text, **options)
    k, gone, worded, n = (fresh(docs.columns, c) for c in ("row_key", "gone", "worded", "copy"))
    verdict = found.groupBy(F.col("row_key").alias(k)).agg(
        F.max(F.col("row_key") != F.col("keeper")).alias(gone), F.max(F.col("content").isNotNull()).alias(worded))
    # the window runs on the join's own partitions and order: no further shuffle
    copy = F.row_number().over(Window.partitionBy(k).orderBy(k))
    return (docs.withColumn(k, row_key(doc_id, text)).join(verdict, k).filter(~F.col(gone)).withColumn(n, copy)
            .filter((F.col(n) == 1) | ~F.col(worded)).select(*docs.columns))
