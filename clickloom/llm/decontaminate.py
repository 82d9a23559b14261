"""Benchmark decontamination by winnowing.

Words are lower-cased runs of digits, letters and characters beyond ASCII. Any
``window`` (10) consecutive words of a benchmark item that a document holds too are hit
there. A fingerprint is the least hash of the word k-grams (k = 5) in a window of 10
words, so each shared window leaves the same fingerprint on both sides. Fingerprints
are joined, and each seed is extended word by word, left and right, as far as a window
through it can reach; 10 or more equal words in a row are a hit. Items of fewer words
are one window: all their words are the gram, and every gram of that length is kept.

What is broadcast is a bitmap of 2^27 bits of the items' fingerprints, 16 MB at any size of
either table; it only thins what is shuffled, the join decides. Seeds carry
the words around them, so the documents themselves are not shuffled before the join. Items with the
same words are joined once.

Edge cases: null and empty texts have no words and no hits; items without words
never occur; documents are rows, so rows that repeat a doc_id and text get equal results,
and rows of one doc_id with unequal texts their own; rows without doc_id are kept;
an item_id counts once; null item_ids are not listed; empty tables give empty or hit-free results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytework import U64, Words, grams, slices, window_min
from clickloom.llm.filters import bitmap_of, in_bitmap
from clickloom.llm.frames import fresh, stage

WINDOW = 10
GRAM = 5

_SEED = "size int, print long, before array<string>, after array<string>"


#: Windows compare the upper half of a hash; the lower half then holds the position, so the leftmost of equals wins.
_LOW = U64(0xFFFFFFFF)


def _winnow(h: np.ndarray, first: np.ndarray, counts: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Positions of the least gram of each window, each once; windows that cross a row's end are left out."""
    width = window - gram + 1
    if len(h) < width:
        return np.zeros(0, np.int64)
    least = (window_min((h & ~_LOW) | np.arange(len(h), dtype=U64), width) & _LOW).astype(np.int64)
    row_of = np.repeat(np.arange(len(counts)), counts)[:len(least)]
    least = least[first[row_of + 1] - np.arange(len(least)) >= window]
    new = np.ones(len(least), dtype=bool)
    new[1:] = least[1:] != least[:-1]  # they never fall
    return least[new]


def _seed_rows(words: Words, row_first: int, row_end: int, at: np.ndarray, prints: np.ndarray, size: int,
               reach: int) -> Iterator[tuple]:
    """A seed's hash, and the words left of it (nearest first) and from it on, as far as a window can reach."""
    for p, value in zip(at.tolist(), prints.tolist(), strict=True):
        before = [words.text(i) for i in range(p - 1, max(row_first, p - reach) - 1, -1)]
        after = [words.text(i) for i in range(p, min(row_end, p + size + reach))]
        yield size, value, before, after


def item_seeds(benchmark: DataFrame, item_id: str, text: str, window: int, gram: int) -> DataFrame:
    """(item text's key, size, print, before, after) of all items, and their ids by key."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column("text"))
            h = grams(words.hashes, gram)
            kept = _winnow(h, words.first, np.diff(words.first), window, gram)
            out: list[tuple] = []
            for row, item in enumerate(part.column("item").to_pylist()):
                first, end = int(words.first[row]), int(words.first[row + 1])
                n = end - first
                if not n:
                    continue
                key = int(grams(words.hashes[first:end], n).view(np.int64)[0])
                if n < window:
                    at, prints, size, reach = np.array([first]), np.array([key]), n, 0
                else:
                    at = kept[(kept >= first) & (kept < end)]
                    prints, size, reach = h[at].view(np.int64), gram, window - gram
                out += [(item, key, *seed) for seed in _seed_rows(words, first, end, at, prints, size, reach)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(_ITEM_ARROW.names, r, strict=True)) for r in out], schema=_ITEM_ARROW)

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"item string, item_key long, {_SEED}")


_SEED_ARROW = pa.schema([("size", pa.int32()), ("print", pa.int64()), ("before", pa.list_(pa.string())),
                         ("after", pa.list_(pa.string()))])
_ITEM_ARROW = pa.schema([("item", pa.string()), ("item_key", pa.int64()), *_SEED_ARROW])
_DOC_ARROW = pa.schema([("doc", pa.int64()), ("content", pa.int64()), ("pos", pa.int64()), ("n_words", pa.int64()),
                        *_SEED_ARROW])


def document_seeds(docs: DataFrame, doc_id: str, text: str, window: int, gram: int, bitmap: np.ndarray,
                   short: list[int]) -> DataFrame:
    """A row with the word count of each document (no position), and one for each seed that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for part in slices(batches, "text"):
            words = Words(part.column("text"))
            counts = np.diff(words.first)
            row_of = np.repeat(np.arange(part.num_rows), counts)
            ids, contents = part.column("doc").to_pylist(), part.column("content").to_pylist()
            out = [(ids[r], contents[r], None, int(counts[r]), None, None, None, None) for r in range(part.num_rows)]
            for size, reach in [(gram, window - gram), *((n, 0) for n in short)]:
                h = grams(words.hashes, size)
                if reach:
                    at = _winnow(h, words.first, counts, window, gram)
                else:  # all grams of a short item's length that lie in one row
                    at = np.flatnonzero(words.first[row_of[:len(h)] + 1] - np.arange(len(h)) >= size)
                at = at[in_bitmap(bits, h[at])]
                prints = h.view(np.int64)
                for p in at.tolist():
                    r = int(row_of[p])
                    first, end = int(words.first[r]), int(words.first[r + 1])
                    for seed in _seed_rows(words, first, end, np.array([p]), prints[p:p + 1], size, reach):
                        out.append((ids[r], contents[r], p - first, None, *seed))
            yield pa.RecordBatch.from_pylist([dict(zip(_DOC_ARROW.names, r, strict=True)) for r in out], schema=_DOC_ARROW)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("content"),
                       F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc long, content long, pos long, n_words long, {_SEED}")


def _equal_run(a: str, b: str) -> Column:
    """How many leading entries of two arrays are equal."""
    return F.expr(f"""aggregate(zip_with(slice({a}, 1, least(size({a}), size({b}))), slice({b}, 1, least(size({a}), size({b}))),
                                         (x, y) -> x = y),
                                named_struct('n', 0, 'on', true),
                                (s, same) -> named_struct('n', s.n + if(s.on and same, 1, 0), 'on', s.on and same), s -> s.n)""")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       gram: int = GRAM) -> DataFrame:
    """(doc, content, n_words, spans, items) of each document, each listing of a (doc_id, text) once.

    ``spans`` are the (start, end) word ranges that are hit, merged and in order; ``items``
    the ids, as text, of the items with a window among them, sorted. ``content`` is xxhash64 of the text.
    """
    items = stage(item_seeds(benchmark, item_id, item_text, window, gram), "item-seeds")
    bitmap = bitmap_of(items, F.col("print"))
    # only items shorter than a window have nothing around their gram: window - 1 lengths at most
    short = sorted(r[0] for r in items.filter("size(before) = 0 and size(after) = size").select("size").distinct().collect())
    found = stage(document_seeds(docs, doc_id, text, window, gram, bitmap, short), "document-seeds")
    by_key = items.select("item_key", "size", "print", F.col("before").alias("item_before"),
                          F.col("after").alias("item_after")).distinct()
    seeds = found.filter("pos is not null").join(by_key, ["size", "print"])
    left, right = _equal_run("before", "item_before"), _equal_run("after", "item_after")
    runs = (seeds.withColumn("l", left).withColumn("r", right)
            # an item shorter than a window is whole in item_after; else ten equal words through the seed
            .filter((F.col("r") >= F.col("size")) & ((F.col("l") + F.col("r") >= window) | (
                (F.size("item_before") == 0) & (F.size("item_after") == F.col("size")))))
            .select("doc", "content", "item_key", (F.col("pos") - F.col("l")).alias("start"),
                    (F.col("pos") + F.col("r")).alias("end")))
    spans = runs.select("doc", "content", "start", "end").distinct().groupBy("doc", "content").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("raw"))
    names = items.select("item_key", "item").filter("item is not null").distinct()
    listed = runs.select("doc", "content", "item_key").distinct().join(names, "item_key").groupBy("doc", "content").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    merged = F.expr("""aggregate(raw, cast(array() as array<struct<start: bigint, end: bigint>>), (done, s) ->
        if(size(done) > 0 and s.start <= element_at(done, -1).end,
           concat(slice(done, 1, size(done) - 1),
                  array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end)))),
           concat(done, array(named_struct('start', s.start, 'end', s.end)))))""")
    hit = spans.select("doc", "content", merged.alias("spans")).join(listed.withColumnsRenamed(
        {"doc": "d2", "content": "c2"}), F.col("doc").eqNullSafe(F.col("d2")) & (F.col("content") == F.col("c2")),
        "left").drop("d2", "c2").withColumnsRenamed({"doc": "d2", "content": "c2"})
    counted = found.filter("pos is null").select("doc", "content", "n_words")
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    return counted.join(hit, F.col("doc").eqNullSafe(F.col("d2")) & (F.col("content") == F.col("c2")), "left").select(
        "doc", "content", "n_words", F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def n_hit() -> Column:
    """Words under the spans of ``contaminated_spans``."""
    return F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, all columns, that hold no window of any benchmark item."""
    hit = contaminated_spans(docs, benchmark, doc_id, text, **options).filter(F.size("spans") > 0).select(
        "doc", "content").distinct()
    d, c = fresh(docs.columns, "hit_doc"), fresh(docs.columns, "hit_content")
    hit = hit.select(F.col("doc").alias(d), F.col("content").alias(c))
    return docs.join(hit, F.col(doc_id).cast("long").eqNullSafe(F.col(d)) & (
        F.xxhash64(F.col(text)) == F.col(c)), "left_anti")
