"""Language-model scores of whole texts: prediction by partial matching, with a unigram base beside it.

The model is learnt from all training documents, grows with them and is never gathered in one place:

1. Texts are staged in compressed blocks of bounded size. Each block counts its distinct tokens and grams (a byte with the
   ``order`` bytes before it): its dictionary, a few per cent of its text.
2. Dictionaries are dealt by key and summed over blocks. What a gram costs depends on its contexts alone:
   distinct grams are grouped by their last two context bytes, where all higher orders lie
   together; orders 0 and 1 have 258 x 257 entries at most and are broadcast. Escapes and exclusions are counted in whole arrays.
3. The sums and log probabilities return to the blocks in the order of their keys, and each block scores its texts.

Texts are lower-cased (A-Z). Tokens are runs of bytes other than white space, then one end. ``adaptive`` codes each text
by its own past instead, without any training.

Edge cases: null texts are empty and have the end alone; null doc_ids count as empty for the training fold; repeated
rows count and are scored each; without training documents every symbol is equally likely and the base is 0;
an empty table has no rows; further columns are not read. Tokens are told apart by a 64 bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytework import U64, lower_ascii, mix, runs, slices, span_hashes, text_array, text_buffer
from clickloom.llm.frames import stage
from clickloom.llm.ppm import ContextTrie, GrowingTrie, counted, levels_of, low, text_grams

ORDER = 5
#: Bytes of text in a block, and worked on at once.
BLOCK_BYTES, SLICE_BYTES = 16 << 20, 1 << 20
TOKEN, GRAM = 0, 1
#: The key of the end of a text among the tokens' hashes.
END_KEY = 0x5DEECE66D

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LONGS = pa.list_(pa.int64())


def text_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows in turn, each row's end included, and each row's first token."""
    raw, at = text_buffer(column)
    data = lower_ascii(raw)
    start, end = runs(~_SPACE[data], at)
    h = span_hashes(data, start, end).view(np.int64)
    first = np.searchsorted(start, at)
    out = np.full(len(h) + len(at) - 1, END_KEY, dtype=np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    out[np.arange(len(h)) + row] = h
    return out, first[:-1] + np.arange(len(at) - 1)


def text_blocks(docs: DataFrame, doc_id: str, text: str, is_training: Column, block_bytes: int) -> DataFrame:
    """(block, docs, training, sizes, texts): consecutive rows; their texts end to end, compressed slice by slice."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", block_bytes):
            ident = part.column("ident").to_numpy().view(U64)
            block = mix(np.array([mix(ident).sum() + U64(part.num_rows)], dtype=U64)).view(np.int64)
            packed = []
            for piece in slices(iter([part]), "text", SLICE_BYTES):
                data, at = text_buffer(piece.column("text"))
                raw = pa.py_buffer(np.ascontiguousarray(data))
                packed.append((piece.column("doc"), piece.column("training"), np.diff(at),
                               pa.compress(raw, codec="zstd", asbytes=True) if len(data) else b""))
            docs, training, sizes, texts = zip(*packed, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array([[d.to_pylist() for d in docs]], pa.list_(_LONGS)),
                 pa.array([[t.to_pylist() for t in training]], pa.list_(pa.list_(pa.bool_()))), pa.array([list(sizes)], pa.list_(_LONGS)),
                 pa.array([list(texts)], pa.list_(pa.binary()))], names=["block", "docs", "training", "sizes", "texts"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(is_training, F.lit(False)).alias("training"),
                       F.xxhash64(F.col(doc_id).cast("long"), F.col(text)).alias("ident"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(
        work, "block long, docs array<array<long>>, training array<array<boolean>>, sizes array<array<long>>, texts array<binary>")


def _unpacked(block: pa.RecordBatch | pa.Table) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The (doc, text) rows of a block, one slice after the other, with their training flags."""
    row = [block.column(c)[0].values for c in ("docs", "training", "sizes", "texts")]
    for docs, training, sizes, packed in zip(*row, strict=True):
        at = np.concatenate([[0], np.cumsum(sizes.values.to_numpy())])
        data = pa.decompress(packed.as_buffer(), int(at[-1]), codec="zstd") if at[-1] else b""
        yield pa.RecordBatch.from_arrays([docs.values, text_array(np.frombuffer(data, np.uint8), at)], names=["doc", "text"]), \
            training.values.to_numpy(zero_copy_only=False)


class _Tally:
    """Keys with summed counts, merged as they come: never much more than twice what there is in the end."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.more = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.more += len(keys)
        if self.more > len(self.keys):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """The different keys in ascending order, and their counts."""
        if self.waiting:
            parts = [(self.keys, self.counts), *self.waiting]
            self.waiting, self.more = [], 0
            self.keys, self.counts = counted(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        return self.keys, self.counts


#: Keys are hashed or packed numbers: a prime modulus deals both evenly, in numpy and in Spark alike.
_PRIME = (1 << 31) - 1


def _shares(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of the parts each key belongs to."""
    return keys % _PRIME % parts


def _part_of(key: str, parts: int) -> Column:
    return F.pmod(F.pmod(F.col(key), F.lit(_PRIME)), F.lit(parts))


def dictionaries(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """(block, kind, part, keys, counts) of the distinct tokens and grams of each block; training texts are counted."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1)
                tallies = {TOKEN: _Tally(), GRAM: _Tally()}
                for part, training in _unpacked(block):
                    for kind, found in ((TOKEN, text_tokens), (GRAM, lambda c: text_grams(c, order))):
                        keys, first = found(part.column("text"))
                        codes, own = pd.factorize(keys)
                        weight = np.repeat(training, np.diff(np.append(first, len(keys)))).astype(float)
                        tallies[kind].add(own, np.bincount(codes, weights=weight, minlength=len(own)).astype(np.int64))
                for kind in list(tallies):
                    yield _packed(block.column("block")[0].as_py(), kind, *tallies.pop(kind).merged(), parts)

    return blocks.mapInArrow(work, "block long, kind int, part long, keys array<long>, counts array<long>")


def _packed(block: int, kind: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    share = _shares(keys, parts)
    by = np.argsort(share, kind="stable")
    some, first = np.unique(share[by], return_index=True)
    offsets = pa.array(np.append(first, len(keys)), pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(some), block)), pa.array(np.full(len(some), kind, np.int32)), pa.array(some),
        pa.ListArray.from_arrays(offsets, pa.array(keys[by])), pa.ListArray.from_arrays(offsets, pa.array(counts[by]))],
        names=["block", "kind", "part", "keys", "counts"])


def _flat(table: pa.Table, keys: str, values: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, values and the row of each, of two list columns."""
    lists, values = table.column(keys).combine_chunks(), table.column(values).combine_chunks()
    return lists.flatten().to_numpy(), values.flatten().to_numpy(), np.repeat(
        np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))


_TOTALS = "key long, n long"


def _summed(table: pa.Table) -> pa.Table:
    keys, counts, _ = _flat(table, "keys", "counts")
    keys, counts = counted(keys, counts)
    return pa.table({"key": keys, "n": counts})


def gram_costs(dictionary: DataFrame, order: int, parts: int) -> DataFrame:
    """(key, cost): log10 probability of every gram that any text holds, from the training counts."""
    totals = stage(dictionary.filter(F.col("kind") == GRAM).groupBy("part").applyInArrow(_summed, _TOTALS), "gram-totals")
    key = F.col("key")
    # orders 0 and 1: 258 x 257 rows at most
    small = totals.filter("n > 0").select(key.bitwiseAND(F.lit(low(2))).alias("key")).distinct().groupBy(
        key.bitwiseAND(F.lit(low(1))).alias("key")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    base = levels_of(small["key"].to_numpy(np.int64), small["n"].to_numpy(np.int64), 1)

    def work(table: pa.Table) -> pa.Table:
        keys, counts = table.column("key").to_numpy(), table.column("n").to_numpy()
        trie = ContextTrie([*base, *levels_of(keys, counts, order, 2)])
        return pa.table({"key": keys, "cost": trie.log2_prob(keys) * np.log10(2.0)})

    context = F.shiftright(key, 9).bitwiseAND(F.lit(low(1)))
    return totals.withColumn("near", F.pmod(F.xxhash64(context), F.lit(parts))).groupBy("near").applyInArrow(
        work, "key long, cost double")


_VALUES = "block long, kind int, part long, counts array<long>, costs array<float>, tokens long, kinds long"
_VALUES_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("counts", _LONGS),
                           ("costs", pa.list_(pa.float32())), ("tokens", pa.int64()), ("kinds", pa.int64())])


def _per_block(table: pa.Table, row: np.ndarray, kind: int, counts: np.ndarray | None = None, costs: np.ndarray | None = None,
               tokens: int = 0, kinds: int = 0) -> pa.Table:
    """The values of each block's keys, in the order the block has them; the part's own sums stand in its first row."""
    n = table.num_rows
    offsets = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
    first = np.arange(n) == 0
    none = pa.nulls(n, _LONGS) if counts is None else pa.nulls(n, pa.list_(pa.float32()))
    lists = pa.ListArray.from_arrays(offsets, pa.array(counts if counts is not None else costs.astype(np.float32)))
    return pa.table({"block": table.column("block"), "kind": np.full(n, kind, np.int32), "part": table.column("part"),
                     "counts": none if counts is None else lists, "costs": lists if counts is None else none,
                     "tokens": first * tokens, "kinds": first * kinds}, schema=_VALUES_ARROW)


def _token_values(table: pa.Table) -> pa.Table:
    keys, counts, row = _flat(table, "keys", "counts")
    own, total = counted(keys, counts)
    return _per_block(table, row, TOKEN, counts=total[np.searchsorted(own, keys)], tokens=int(total.sum()),
                      kinds=int((total > 0).sum()))


def _gram_values(table: pa.Table, costs: pa.Table) -> pa.Table:
    keys, _, row = _flat(table, "keys", "counts")
    own, cost = costs.column("key").to_numpy(), costs.column("cost").to_numpy()
    by = np.argsort(own)
    return _per_block(table, row, GRAM, costs=cost[by][np.searchsorted(own[by], keys)])


def _scorer(order: int, parts: int):
    def work(blocks: pa.Table, values: pa.Table) -> pa.Table:
        given: dict[tuple, np.ndarray] = {}
        for kind, part, *lists in zip(*(values.column(c) for c in ("kind", "part", "counts", "costs")), strict=True):
            given[kind.as_py(), part.as_py()] = lists[kind.as_py()].values.to_numpy()
        if not blocks.num_rows:
            return _SCORED_ARROW.empty_table()
        known = {}
        for kind, found in ((TOKEN, text_tokens), (GRAM, lambda c: text_grams(c, order))):
            tally = _Tally()
            for part, _ in _unpacked(blocks):
                keys = pd.unique(found(part.column("text"))[0])
                tally.add(keys, np.zeros(len(keys), np.int64))
            keys = tally.merged()[0]
            by = np.argsort(_shares(keys, parts), kind="stable")  # the order the values come in
            value = np.concatenate([given.pop(k) for k in sorted(k for k in given if k[0] == kind)] or [np.zeros(0)])
            if len(keys) != len(value):
                raise RuntimeError("a block's dictionary is not whole")
            sorted_value = np.empty_like(value)
            sorted_value[by] = value
            known[kind] = keys, sorted_value

        def looked_up(kind: int, keys: np.ndarray) -> np.ndarray:
            codes, own = pd.factorize(keys)
            return known[kind][1][np.searchsorted(known[kind][0], own)][codes]

        out = []
        for i in range(blocks.num_rows):  # more than one only if whole blocks are repeated
            for part, training in _unpacked(blocks.slice(i, 1)):
                tokens, first = text_tokens(part.column("text"))
                count = looked_up(TOKEN, tokens)
                grams, first_gram = text_grams(part.column("text"), order)
                out.append(pa.table({
                    "doc_id": part.column("doc"), "training": training, "n_tokens": np.diff(np.append(first, len(tokens))),
                    "n_known": np.add.reduceat((count > 0).astype(np.int64), first),
                    "log10_counts": np.add.reduceat(np.log10(count + 0.1), first),
                    "score": np.add.reduceat(looked_up(GRAM, grams).astype(float), first_gram)}, schema=_SCORED_ARROW))
        return pa.concat_tables(out) if out else _SCORED_ARROW.empty_table()

    return work


_SCORED = "doc_id long, training boolean, n_tokens long, n_known long, log10_counts double, score double"
_SCORED_ARROW = pa.schema([("doc_id", pa.int64()), ("training", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                           ("log10_counts", pa.float64()), ("score", pa.float64())])


def score_texts(docs: DataFrame, is_training: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    if not 2 <= order <= 5:
        raise ValueError("the order is 2 to 5")
    blocks = stage(text_blocks(docs, doc_id, text, is_training, block_bytes), "text-blocks")
    parts = max(1, blocks.count())
    dictionary = stage(dictionaries(blocks, order, parts), "dictionaries")
    tokens, grams = (dictionary.filter(F.col("kind") == k) for k in (TOKEN, GRAM))
    costs = stage(gram_costs(dictionary, order, parts), "gram-costs").withColumn("part", _part_of("key", parts))
    values = stage(tokens.groupBy("part").applyInArrow(_token_values, _VALUES).unionByName(
        grams.groupBy("part").cogroup(costs.groupBy("part")).applyInArrow(_gram_values, _VALUES)), "dictionary-values")
    n, v = values.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    scored = blocks.groupBy("block").cogroup(values.drop("tokens", "kinds").groupBy("block")).applyInArrow(
        _scorer(order, parts), _SCORED)
    base = F.col("log10_counts") - F.col("n_tokens") * float(np.log10(n + 0.1 * (v + 1)))
    return scored.select("doc_id", "training", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         base.alias("base_score"), "score")


def adaptive_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, score): log10 probability of each text coded by its own past."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [GrowingTrie(order).text_log2_prob(t or "", True) * float(np.log10(2.0)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, score double")
