"""Alignment of the tokens two tokenizers make of the same texts, anchored at white space.

Each text is tokenised whole by both: space + text by a byte-level BPE (A), the text by a piece model that adds the space
itself (B). Both token sequences spell the same bytes, or the text has no tokens here. A group ends wherever
an A token and a B token end at the same byte; two tokens of a group are linked.

1. Anchors: places where both an A token and a B token that begin with a space start, so both have just ended: the shared
   end is verified, not assumed. They cut a text into windows of token ids.
2. Windows of a slice of texts are told apart by hash and compared id by id with the one they are taken for.
   Each different one is looked up by its tuples of ids in a memo that lasts as long as the Python worker; the new ones of
   a slice are aligned together. The memo is emptied beyond MEMO entries; windows of over LONG tokens are aligned each time.
3. A block of texts has a dictionary of the id pairs linked in it, with the number of its documents that hold
   each, and per document the pairs by their place in the dictionary. Spark sums dictionaries by pair, takes
   the highest count per A id, and returns both to the blocks that hold the pair.

Nothing about pairs is broadcast or collected. Blocks are bounded (BLOCK_BYTES of text, or one longer text).

Edge cases: null and empty texts, and those whose bytes a tokenizer changes, have no tokens: zeros and no groups;
rows that repeat a doc_id are documents of their own; very long texts without white space are one window;
strings of special tokens are ordinary text; an empty table has no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytework import MULTIPLIERS, U64, mix, slices, span_hashes, text_buffer
from clickloom.llm.frames import stage

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text in a block, and worked on at once.
BLOCK_BYTES, SLICE_BYTES = 8 << 20, 1 << 20
MEMO, LONG = 200_000, 64

#: The split rule of the byte-level vocabulary's pre-tokenizer: fixed value.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Vocabulary:
    """Bytes of every token id, in one buffer."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.spaced = np.array([t[:1] == b" " for t in tokens])

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        end = np.cumsum(size)
        return self.data[np.arange(end[-1] if len(ids) else 0) + np.repeat(self.at[ids] - end + size, size)]


class ByteLevel(Vocabulary):
    """Tokenizer A. A vocabulary whose ids follow its merges is run by the quicker of the two libraries that give the same ids."""

    def __init__(self, path: str):
        own = tokenizers.Tokenizer.from_file(path)
        own.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, special = spec["model"], {a["content"] for a in spec["added_tokens"]}
        byte = byte_symbols()
        tokens = [b""] * own.get_vocab_size()
        for token, i in own.get_vocab().items():
            tokens[i] = token.encode() if token in special else bytes(byte[c] for c in token)
        super().__init__(tokens)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        rest = {k: v for k, v in (spec["pre_tokenizer"] or {}).items() if k != "trim_offsets"}
        plain = rest == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} and not spec["normalizer"]
        if plain and not model.get("ignore_merges") and all(
                model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges)):
            ranks = {tokens[i]: i for t, i in model["vocab"].items() if t not in special}
            quick = tiktoken.Encoding("byte-level", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [quick.encode_ordinary(t) for t in texts]
        else:
            self.encode = lambda texts: [own.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces(Vocabulary):
    """Tokenizer B."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([
            bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))])
        self.encode = lambda texts: model.encode(texts, num_threads=1)


@cache
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


class _Store:
    """Rows of different length, end to end, that grow."""

    def __init__(self, kind: type):
        self.data, self.at = np.zeros(1 << 10, dtype=kind), np.zeros(1 << 10, dtype=np.int64)
        self.rows = self.end = 0

    def add(self, data: np.ndarray, sizes: np.ndarray) -> None:
        ends = self.end + np.cumsum(sizes)
        while len(self.data) < self.end + len(data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        while len(self.at) <= self.rows + len(sizes):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.data[self.end:self.end + len(data)] = data
        self.at[self.rows + 1:self.rows + 1 + len(sizes)] = ends
        self.rows, self.end = self.rows + len(sizes), self.end + len(data)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The data of some rows end to end, and their sizes."""
        sizes = self.at[rows + 1] - self.at[rows]
        ends = np.cumsum(sizes)
        return self.data[np.arange(ends[-1] if len(rows) else 0) + np.repeat(self.at[rows] - ends + sizes, sizes)], sizes


class Memo:
    """Alignments of windows by their id tuples: text of the groups (`;` after each), groups, links, linked pairs and how often."""

    def __init__(self, vocab_a: Vocabulary, vocab_b: Vocabulary):
        self.vocab_a, self.vocab_b = vocab_a, vocab_b
        most = max(len(vocab_a.size), len(vocab_b.size))
        self.decimal = Vocabulary([str(i).encode() for i in range(most)])
        self.clear()

    def clear(self) -> None:
        #: hashes in order and the entry of each; the ids of every entry tell whether it is the one
        self.hashes, self.entry = np.zeros(0, U64), np.zeros(0, np.int64)
        self.a, self.b = _Store(np.int64), _Store(np.int64)
        self.text, self.codes, self.times = _Store(np.uint8), _Store(np.int64), _Store(np.int64)
        self.groups, self.links = _Store(np.int64), _Store(np.int64)

    def entries(self, hashes: np.ndarray, a: np.ndarray, b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray,
                b1: np.ndarray) -> np.ndarray:
        """The entry of each window; windows that are not known yet are aligned together."""
        if self.text.rows >= MEMO or self.text.end >= MEMO * LONG * 8:
            self.clear()
        out = np.full(len(hashes), -1, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[at] == hashes)
            entry = self.entry[at[hit]]
            same = _equal(self.a, entry, a, a0[hit], a1[hit]) & _equal(self.b, entry, b, b0[hit], b1[hit])
            out[hit[same]] = entry[same]
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = self.text.rows + np.arange(len(new))
            (ids_a, first_a), (ids_b, first_b) = _picked(a, a0[new], a1[new]), _picked(b, b0[new], b1[new])
            self._align(ids_a, first_a, ids_b, first_b)
            size_a, size_b = (a1 - a0)[new], (b1 - b0)[new]
            kept = size_a + size_b <= LONG
            for store, ids, sizes in ((self.a, ids_a, size_a), (self.b, ids_b, size_b)):
                store.add(ids[np.repeat(kept, sizes)], np.where(kept, sizes, 0))
            # of equal hashes the first stays
            self.hashes, one = np.unique(np.concatenate([self.hashes, hashes[new[kept]]]), return_index=True)
            self.entry = np.concatenate([self.entry, out[new[kept]]])[one]
        return out

    def _align(self, a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray) -> None:
        """Add the alignments of these windows, whose tokens lie end to end."""
        ends_a, ends_b = np.cumsum(self.vocab_a.size[a]), np.cumsum(self.vocab_b.size[b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        n_a, n_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        first_group = group_a[first_a]
        self.groups.add(np.diff(np.append(first_group, len(shared))), np.ones(len(first_a), np.int64))
        links = n_a * n_b
        self.links.add(np.add.reduceat(links, first_group), np.ones(len(first_a), np.int64))
        self._text(a, b, group_a, group_b, n_a, n_b, start_a, start_b, first_group)
        # pairs: all of a group, or where it is long each different one once
        window = np.repeat(np.arange(len(first_a)), np.diff(np.append(first_group, len(shared))))
        short = links <= LONG * LONG
        each = np.where(short, links, 0)
        place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        wide = np.repeat(n_b, each)
        codes = (a[np.repeat(start_a, each) + place // wide] << 32) + b[np.repeat(start_b, each) + place % wide]
        owner, times = np.repeat(window, each), np.ones(len(codes), np.int64)
        for g in np.flatnonzero(~short).tolist():
            (p, m), (q, n) = (np.unique(x[s:s + size], return_counts=True) for x, s, size in ((a, start_a[g], n_a[g]), (b, start_b[g], n_b[g])))
            codes = np.concatenate([codes, ((p[:, None] << 32) + q[None, :]).ravel()])
            times = np.concatenate([times, (m[:, None] * n[None, :]).ravel()])
            owner = np.concatenate([owner, np.full(len(p) * len(q), window[g])])
        by = np.lexsort((codes, owner))
        codes, owner, times = codes[by], owner[by], times[by]
        new = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])))
        sizes = np.bincount(owner[new], minlength=len(first_a))
        self.codes.add(codes[new], sizes)
        self.times.add(np.add.reduceat(times, new), sizes)

    def _text(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
              start_a: np.ndarray, start_b: np.ndarray, first_group: np.ndarray) -> None:
        """Ids in the order of the groups, A before B, each followed by its separator."""
        place_a = np.arange(len(a)) + start_b[group_a]
        place_b = np.arange(len(b)) + (start_a + n_a)[group_b]
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        last_a = start_a + n_a - 1 + start_b
        after[last_a], after[last_a + n_b] = ord("|"), ord(";")
        sizes = self.decimal.size[ids]
        ends = np.cumsum(sizes + 1)
        out = np.empty(int(ends[-1]), np.uint8)
        out[ends - 1] = after
        digits = np.ones(len(out), dtype=bool)
        digits[ends - 1] = False
        out[digits] = self.decimal.spelled(ids)
        self.text.add(out, np.add.reduceat(sizes + 1, (start_a + start_b)[first_group]))


def _equal(store: _Store, entry: np.ndarray, ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each window's ids are those of the entry it may be."""
    size = end - start
    same = store.at[entry + 1] - store.at[entry] == size
    rows = np.flatnonzero(same)
    held, _ = store.take(entry[rows])
    picked, _ = _picked(ids, start[rows], end[rows])
    same[np.repeat(rows, size[rows])[held != picked]] = False
    return same


def _picked(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some windows end to end, and where each begins."""
    size = end - start
    first = np.cumsum(size) - size
    return ids[np.repeat(start - first, size) + np.arange(size.sum())], first


@cache
def memo(path_a: str, path_b: str) -> Memo:
    return Memo(byte_level(path_a), pieces(path_b))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and the n + 1 offsets of the lists."""
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(at[-1])), at


def _without(ids: np.ndarray, at: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.where(keep, np.diff(at), 0)
    return ids[np.repeat(keep, np.diff(at))], np.concatenate([[0], np.cumsum(size)])


def _spells(ids: np.ndarray, at: np.ndarray, vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row's tokens spell exactly its bytes."""
    size = np.concatenate([[0], np.cumsum(vocab.size[ids])])[at]
    good = np.diff(size) == np.diff(offsets)
    kept, _ = _without(ids, at, good)
    want = data[np.repeat(good, np.diff(offsets))]
    rows = np.repeat(np.flatnonzero(good), np.diff(offsets)[good])
    good[rows[vocab.spelled(kept) != want]] = False
    return good


def _different(a: np.ndarray, b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, ...]:
    """One window of each different kind, its hash, and the kind of every window; kinds are equal id by id."""
    h = mix(span_hashes(a, a0, a1, 0) + span_hashes(b, b0, b1, 1) * U64(MULTIPLIERS[0]))
    _, first, kind = np.unique(h, return_index=True, return_inverse=True)
    rep = first[kind]
    same = (a1 - a0 == a1[rep] - a0[rep]) & (b1 - b0 == b1[rep] - b0[rep])
    for ids, start, end in ((a, a0, a1), (b, b0, b1)):
        if same.all():
            size = end - start
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            row = np.repeat(np.arange(len(size)), size)
            same[row[ids[start[row] + place] != ids[start[rep[row]] + place]]] = False
    if same.all():
        return first, h[first], kind
    seen: dict[tuple, int] = {}  # two different windows of one hash
    kind = np.array([seen.setdefault((a[s:e].tobytes(), b[u:v].tobytes()), len(seen)) for s, e, u, v in zip(a0, a1, b0, b1, strict=True)])
    first = np.unique(kind, return_index=True)[1]
    return first, h[first], kind


class Slice:
    """The alignment of a slice's texts: figures and groups per row, and the pairs of each row by their place in ``codes``."""

    def __init__(self, texts: pa.Array, path_a: str, path_b: str, digest: bool):
        vocab_a, vocab_b = byte_level(path_a), pieces(path_b)
        n = len(texts)
        spaced = [" " + t if t else "" for t in texts.to_pylist()]
        data, offsets = text_buffer(pa.array(spaced, pa.large_string()))
        a, at_a = _flat([x if t else [] for x, t in zip(vocab_a.encode(spaced), spaced, strict=True)])
        b, at_b = _flat([x if t else [] for x, t in zip(vocab_b.encode([t[1:] for t in spaced]), spaced, strict=True)])
        good = _spells(a, at_a, vocab_a, data, offsets)
        good &= _spells(b, at_b, vocab_b, data, offsets)
        (a, at_a), (b, at_b) = _without(a, at_a, good), _without(b, at_b, good)
        self.n_a, self.n_b = np.diff(at_a), np.diff(at_b)
        start_a, start_b = (np.cumsum(v.size[x]) - v.size[x] for v, x in ((vocab_a, a), (vocab_b, b)))
        full = np.flatnonzero(self.n_a > 0)
        first = start_a[at_a[full]] if len(a) else np.zeros(0, np.int64)
        anchors = np.union1d(first, np.intersect1d(start_a[vocab_a.spaced[a]], start_b[vocab_b.spaced[b]], assume_unique=True))
        a0, b0 = np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)
        a1, b1 = np.append(a0[1:], len(a)), np.append(b0[1:], len(b))
        row = full[np.searchsorted(first, anchors, side="right") - 1]
        one, hashes, kind = _different(a, b, a0, a1, b0, b1)
        store = memo(path_a, path_b)
        entry = store.entries(hashes, a, b, a0[one], a1[one], b0[one], b1[one])
        self.n_groups, self.n_links = (
            np.bincount(row, weights=x.data[entry[kind]].astype(float), minlength=n).astype(np.int64) for x in (store.groups, store.links))
        shown, sizes = store.text.take(entry[kind])
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(row, np.arange(n + 1))].tolist()
        whole = [shown[s:e - 1].tobytes() if e > s else b"" for s, e in zip(ends, ends[1:])]
        self.groups = [(hashlib.sha256(x).hexdigest() if x else "") if digest else x.decode() for x in whole]
        self._pairs(store, entry, kind, row, n)

    def _pairs(self, store: Memo, entry: np.ndarray, kind: np.ndarray, row: np.ndarray, n: int) -> None:
        (codes, sizes), (times, _) = store.codes.take(entry), store.times.take(entry)
        at = np.cumsum(sizes) - sizes
        self.codes, place = np.unique(codes, return_inverse=True)
        of_row, count = np.unique(row * max(1, len(entry)) + kind, return_counts=True)
        r, k = of_row // max(1, len(entry)), of_row % max(1, len(entry))
        size = sizes[k]
        each = np.repeat(at[k] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key = np.repeat(r, size) * max(1, len(self.codes)) + place[each]
        own, back = np.unique(key, return_inverse=True)
        self.times = np.bincount(back, weights=(times[each] * np.repeat(count, size)).astype(float), minlength=len(own)).astype(np.int64)
        self.places = own % max(1, len(self.codes))
        self.sizes = np.bincount(own // max(1, len(self.codes)), minlength=n)


_LONGS = pa.list_(pa.int64())
_BLOCK = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups array<string>, sizes array<long>, pairs binary, codes array<long>, held array<long>")


def _block(block: int, ids: list, parts: list[Slice]) -> pa.RecordBatch:
    joined = {c: np.concatenate([getattr(p, c) for p in parts]) for c in ("n_a", "n_b", "n_groups", "n_links", "sizes", "times")}
    codes = np.unique(np.concatenate([p.codes for p in parts]))
    places = np.concatenate([np.searchsorted(codes, p.codes)[p.places] for p in parts])
    pairs = np.concatenate([places, joined["times"]]).astype(np.int64 if joined["times"].max(initial=0) >= 1 << 31 else np.int32)
    packed = pa.compress(pa.py_buffer(bytes([pairs.itemsize]) + pairs.tobytes()), codec="zstd", asbytes=True)
    lists = [pa.array([joined[c]], _LONGS) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([ids], _LONGS), *lists,
         pa.array([[g for p in parts for g in p.groups]], pa.list_(pa.string())), pa.array([joined["sizes"]], _LONGS),
         pa.array([packed], pa.binary()), pa.array([codes], _LONGS),
         pa.array([np.bincount(places, minlength=len(codes))], _LONGS)],
        names=[c.split()[0] for c in _BLOCK.split(", ")])


def aligned_blocks(docs: DataFrame, doc_id: str, text: str, path_a: str, path_b: str, digest: bool, block_bytes: int) -> DataFrame:
    """A row for each block of documents, its pairs and their dictionary included."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids: list = []
        parts: list[Slice] = []
        held = 0
        for rows in slices(batches, "text", min(SLICE_BYTES, block_bytes)):
            parts.append(Slice(rows.column("text"), path_a, path_b, digest))
            ids += rows.column("doc").to_pylist()
            held += len(text_buffer(rows.column("text"))[0])
            if held >= block_bytes:
                yield _block(block, ids, parts)
                block, ids, parts, held = block + 1, [], [], 0
        if parts:
            yield _block(block, ids, parts)

    return docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(work, _BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(code, n, best): how many documents hold each pair, and whether that is the highest count of its A id."""
    held = blocks.select(F.explode(F.arrays_zip("codes", "held")).alias("x")).groupBy(F.col("x.codes").alias("code")).agg(
        F.sum("x.held").alias("n"))
    counts = stage(held, "pair-counts").withColumn("a", F.shiftright("code", 32))
    # no more rows than tokenizer A has ids
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(top, "a").select("code", "n", (F.col("n") == F.col("top")).alias("best"))


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_RESULT_ARROW = pa.schema([*((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                           ("groups", pa.string())])


def _counted(blocks: pa.Table, values: pa.Table) -> pa.Table:
    if not blocks.num_rows:
        return _RESULT_ARROW.empty_table()
    row = {c: blocks.column(c).combine_chunks() for c in blocks.column_names}
    n, best, code = (values.column(c).to_numpy() for c in ("n", "best", "code"))
    by = np.argsort(code)
    n, best = n[by], best[by].astype(np.int64)
    if len(n) != len(row["codes"].flatten()):
        raise RuntimeError("a block's dictionary is not whole")
    raw = row["pairs"][0].as_py()
    sizes = row["sizes"].flatten().to_numpy()
    total = int(sizes.sum())
    # the first byte tells the width
    wide = pa.CompressedInputStream(pa.BufferReader(raw), "zstd").read()
    numbers = np.frombuffer(wide, np.int64 if wide[0] == 8 else np.int32, offset=1)
    places, times = numbers[:total], numbers[total:].astype(np.int64)

    def per_row(x: np.ndarray) -> np.ndarray:
        end = np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], np.cumsum(sizes)])]
        return np.diff(end)

    plain = {c: row[c].flatten() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")}
    return pa.table({**plain, "n_best": per_row(times * best[places]), "count_sum": per_row(times * n[places])}).select(
        _RESULT_ARROW.names).cast(_RESULT_ARROW)


def align_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str = BYTE_LEVEL, path_b: str = PIECES,
                 digest: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    ``groups`` is the alignment, `a1,a2|b1;a3|b2,b3` with the ids of A and B in order, or its SHA-256 if ``digest``.
    """
    blocks = stage(aligned_blocks(docs, doc_id, text, path_a, path_b, digest, block_bytes), "aligned-blocks")
    places = blocks.select(F.col("block").alias("of"), F.explode("codes").alias("code"))
    values = places.join(pair_counts(blocks), "code")
    return blocks.drop("held").groupBy("block").cogroup(values.groupBy("of")).applyInArrow(_counted, _RESULT)
