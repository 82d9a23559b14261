"""Prediction by partial matching over bytes: grams, context tries, code lengths.

A text is its bytes and one END symbol, after ``order`` START symbols. A gram is a symbol with the ``order`` symbols before
it, nine bits each, the oldest on top, so the low bits of a gram are the grams of lower orders. A trie holds, for each
order, counts of (context, symbol): at the top order how often the pair came in training text, below it how many different
contexts one symbol longer it came in (a symbol is counted at lower orders only where the longer context had not seen it).
A symbol is coded at the longest context seen in training; where that context has not seen it, the escape
is coded and the search goes on one symbol shorter, without the symbols the longer context has already ruled out.
With n the sum of the counts of the d symbols left in a context, a symbol of count c has (c - DISCOUNT) / n and the escape
DISCOUNT * d / n. Below order 0 all symbols not ruled out are equally likely.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

from clickloom.llm.bytework import lower_ascii, text_buffer

END, START = 256, 257
BITS = 9
#: Bytes and END; START is never coded.
ALPHABET = 257
#: What every symbol of a context gives up for the escape.
DISCOUNT = 0.3


def low(order: int) -> int:
    """Mask of a gram of this order; of its context one order less."""
    return (1 << (BITS * (order + 1))) - 1


def text_grams(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all rows in turn, with A-Z in lower case, and each row's first gram."""
    data, at = text_buffer(column)
    rows = len(at) - 1
    symbols = np.full(len(data) + rows * (order + 1), START, dtype=np.int64)
    lengths = np.diff(at)
    begin = at[:-1] + np.arange(rows) * (order + 1) + order
    shift = np.repeat(begin - at[:-1], lengths)
    symbols[np.arange(len(data)) + shift] = lower_ascii(data)
    symbols[begin + lengths] = END
    grams = symbols.copy()
    n = len(symbols)
    for back in range(1, order + 1):
        grams[order:] |= symbols[order - back:n - back] << (BITS * back)
    return grams[symbols != START], at[:-1] + np.arange(rows)


def counted(grams: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, sorted, with their counts."""
    if weights is None:
        codes, keys = pd.factorize(grams)
        counts = np.bincount(codes, minlength=len(keys)).astype(np.int64)
        by = np.argsort(keys)
        return keys[by], counts[by]
    by = np.argsort(grams, kind="stable")
    keys, weights = grams[by], weights[by]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def levels_of(grams: np.ndarray, counts: np.ndarray, order: int, least: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) for the orders ``least`` to ``order`` from the top grams."""
    keys, counts = counted(grams, counts)
    levels = [(keys[counts > 0], counts[counts > 0])]
    for k in range(order - 1, least - 1, -1):
        longer = levels[0][0]
        levels.insert(0, counted(longer & low(k), np.ones(len(longer), dtype=np.int64)))
    return levels


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values at the wanted keys, 0 where a key is missing."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


class ContextTrie:
    """Frozen statistics: for each order the counted grams, and for each context its totals."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.levels = levels
        self.contexts, self.total, self.kinds, self.ruled_out = [], [], [], []
        for order, (keys, counts) in enumerate(self.levels):
            context = keys >> BITS
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(keys) else np.zeros(0, np.int64)
            sums = (lambda v, first=first: np.add.reduceat(v, first) if len(first) else np.zeros(0, np.int64))
            self.contexts.append(context[first])
            self.total.append(sums(counts))
            self.kinds.append(sums(np.ones(len(keys), np.int64)))
            # occurrences one order lower of the symbols this context has seen
            shorter = self.levels[order - 1] if order else None
            self.ruled_out.append(sums(_find(*shorter, keys & low(order - 1))) if order else self.kinds[-1] * 0)

    def log2_prob(self, grams: np.ndarray) -> np.ndarray:
        """Log2 probability of each gram's symbol after its context."""
        out = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        gone_n = gone_d = np.zeros(len(grams), dtype=np.int64)
        for order in range(len(self.levels) - 1, -1, -1):
            gram = grams[open_] & low(order)
            context = gram >> BITS
            kinds = _find(self.contexts[order], self.kinds[order], context)
            n = _find(self.contexts[order], self.total[order], context) - gone_n
            d = kinds - gone_d
            count = _find(*self.levels[order], gram)
            coded = count > 0
            with np.errstate(divide="ignore"):
                share = np.log2(np.where(coded, count - DISCOUNT, DISCOUNT * d)) - np.log2(np.maximum(n, 1))
            out[open_] += np.where(n > 0, share, 0.0)
            stay = ~coded
            gone_n = _find(self.contexts[order], self.ruled_out[order], context)[stay]
            gone_d = kinds[stay]
            open_ = open_[stay]
        out[open_] -= np.log2(np.maximum(ALPHABET - gone_d, 1))
        return out


class GrowingTrie:
    """The same model one symbol at a time: for adaptive coding, where each text's own past is all that is known."""

    def __init__(self, order: int):
        self.order = order
        self.seen: list[dict[bytes | tuple, dict[int, int]]] = [{} for _ in range(order + 1)]

    @staticmethod
    def symbols(text: str) -> list[int]:
        return [b + 32 if 65 <= b <= 90 else b for b in text.encode()] + [END]

    def log2_prob(self, context: tuple[int, ...], symbol: int) -> float:
        """``context``: the ``order`` symbols before, the last one at the end."""
        out, gone = 0.0, set()
        for order in range(self.order, -1, -1):
            found = self.seen[order].get(context[self.order - order:], {})
            left = {s: n for s, n in found.items() if s not in gone}
            if not left:
                continue
            total = sum(left.values())
            if symbol in left:
                return out + float(np.log2((left[symbol] - DISCOUNT) / total))
            out += float(np.log2(DISCOUNT * len(left) / total))
            gone |= left.keys()
        return out - float(np.log2(max(ALPHABET - len(gone), 1)))

    def learn(self, context: tuple[int, ...], symbol: int) -> None:
        for order in range(self.order, -1, -1):
            counts = self.seen[order].setdefault(context[self.order - order:], {})
            counts[symbol] = counts.get(symbol, 0) + 1
            if counts[symbol] > 1:
                return  # known here, so nothing new to shorter contexts

    def text_log2_prob(self, text: str, learn: bool) -> float:
        context, out = (START,) * self.order, 0.0
        for s in self.symbols(text):
            out += self.log2_prob(context, s)
            if learn:
                self.learn(context, s)
            context = (*context[1:], s) if self.order else ()
        return out
