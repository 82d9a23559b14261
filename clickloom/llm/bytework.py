"""Byte-level helpers for Arrow batches: buffers, slicing by size, rolling hashes, words.

All hashes are of content alone, the same in every task and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomial hashes, and their inverses modulo 2^64.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
INVERSES = tuple(pow(m, -1, 1 << 64) for m in MULTIPLIERS)

#: Bytes of text worked on at once within a batch.
CHUNK_BYTES = 2 << 20


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def text_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The reverse of ``text_buffer``."""
    kind = kind or pa.large_string()
    return pa.Array.from_buffers(
        kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of at most ``most`` bytes of text, or one row where that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = text_buffer(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + most, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64 bit hash of each values[start:end], the same for equal content and length wherever it lies."""
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum((values.astype(U64) + U64(1)) * powers(MULTIPLIERS[which], len(values)), out=total[1:])
    back = powers(INVERSES[which], len(values) + 1)
    lengths = (ends - starts).astype(U64)
    return mix((total[ends] - total[starts]) * back[starts] + mix(lengths + U64(which)))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return data | (((data >= 65) & (data <= 90)).view(np.uint8) << 5)


def runs(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags; no run crosses a row's border."""
    n = len(flags)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = flags
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    after = np.append(flags, False)
    starts = np.flatnonzero(after & (~before | border))
    ends = np.flatnonzero(before & (~after | border))
    return starts, ends


#: Bytes of the words that decontamination and shingles are made of: digits, letters, all beyond ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


class Words:
    """Lower-cased words of the rows of a text column."""

    def __init__(self, column: pa.Array):
        raw, self.offsets = text_buffer(column)
        self.data = lower_ascii(raw)
        self.starts, self.ends = runs(_WORD[self.data], self.offsets)
        #: first word of each row, and the total
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = span_hashes(self.data, self.starts, self.ends)

    def text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive values; n - k + 1 of them."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, dtype=U64)
    for i in range(k):
        out = out * U64(MULTIPLIERS[0]) + hashes[i:i + n]
    return mix(out)


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out
