"""Suffix arrays of sets of short byte strings by induced sorting, and their permuted common prefixes.

The strings are laid out one after another, each closed by a separator of its own: smaller than
all bytes, and ordered by place, so no common prefix runs over a string's end.

Suffixes are classified (S if smaller than the next one, else L); the leftmost S of each run (LMS)
cuts the text into substrings, which one round of induced sorting puts in order; equal ones get
equal names and the suffixes of the string of names, at most half as long, are sorted by doubling; from their
order that of all is induced linearly, a whole bucket of one byte at a time. Induction and doubling are numpy over
whole arrays; doubling takes a round more for each doubling of the longest common prefix.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True for S. The end of the text is smaller than all, so the last suffix is L."""
    n = len(s)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(s[1:] - s[:-1])
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]  # equal neighbours are of the type of the next unequal pair
    return step[at] > 0


def _names(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names, from 0, of the LMS substrings, given the places of the LMS suffixes in the order of their substrings."""
    ends = np.append(lms[1:], len(s) - 1)
    length = np.zeros(len(s), dtype=np.int64)
    length[lms] = ends - lms
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    same &= order[1:] != lms[-1]  # the last substring ends with the text: it equals none
    same &= order[:-1] != lms[-1]
    open_, k = np.flatnonzero(same), 0
    while len(open_):
        equal = s[a[open_] + k] == s[b[open_] + k]
        same[open_[~equal]] = False
        open_ = open_[equal]
        k += 1
        open_ = open_[length[a[open_]] >= k]
    out = np.empty(len(s), dtype=np.int64)
    out[order] = np.concatenate([[0], np.cumsum(~same)])
    return out[lms]


class _Buckets:
    """Induced sorting of a text of separators and bytes, a bucket at a time."""

    def __init__(self, bucket: np.ndarray, is_s: np.ndarray):
        self.bucket, self.is_s, self.n = bucket, is_s, len(bucket)
        self.size = np.bincount(bucket, minlength=257)
        self.tail = np.cumsum(self.size)
        self.head = self.tail - self.size
        self.larger = np.bincount(bucket[~is_s], minlength=257)  # L suffixes of each bucket
        self.used = np.flatnonzero(self.size)
        self.separators = np.flatnonzero(bucket == 0)

    def _deal(self, out: np.ndarray, place: np.ndarray, items: np.ndarray, sign: int) -> None:
        """Puts items, in order, to the next places of their buckets."""
        if not len(items):
            return
        to = self.bucket[items]
        order = np.argsort(to, kind="stable")
        counts = np.bincount(to, minlength=257)
        rank = np.arange(len(items)) - np.repeat(np.cumsum(counts) - counts, counts)
        out[place[to[order]] + sign * rank] = items[order]
        place += sign * counts

    def induce(self, lms: np.ndarray) -> np.ndarray:
        """The suffixes in the order that the LMS suffixes, in this order, induce."""
        bucket, is_s = self.bucket, self.is_s
        out = np.full(self.n, -1, dtype=np.int64)
        by = np.argsort(bucket[lms], kind="stable")
        seeds, seed_count = lms[by], np.bincount(bucket[lms], minlength=257)
        seed_at = np.concatenate([[0], np.cumsum(seed_count)])
        # L suffixes, from the smallest bucket: each comes after the suffix it is followed by
        place = self.head.copy()
        for c in self.used.tolist():
            if c == 0:  # separators, the text's end among them, are known to be in order of place
                before = self.separators[self.separators > 0] - 1
                self._deal(out, place, before[~is_s[before]], 1)
                continue
            done = self.head[c]
            while done < place[c]:
                now = out[done:place[c]]
                done = place[c]
                before = now[now > 0] - 1
                self._deal(out, place, before[~is_s[before]], 1)
            before = seeds[seed_at[c]:seed_at[c + 1]]
            before = before[before > 0] - 1
            self._deal(out, place, before[~is_s[before]], 1)
        # S suffixes, from the largest bucket and from the right
        place = self.tail - 1
        for c in self.used[::-1].tolist():
            done = self.tail[c] - 1
            if c == 0:
                break
            while done > place[c]:
                now = out[place[c] + 1:done + 1][::-1]
                done = place[c]
                before = now[now > 0] - 1
                self._deal(out, place, before[is_s[before]], -1)
            now = out[self.head[c]:self.head[c] + self.larger[c]][::-1]
            before = now[now > 0] - 1
            self._deal(out, place, before[is_s[before]], -1)
        out[:len(self.separators)] = self.separators  # separators are in order of place
        return out


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array of a text of small whole numbers: suffixes in order of their first k numbers are put in that of 2k.

    Only suffixes that are not yet told apart are sorted again, so rounds and rows end with the longest common prefix.
    """
    n = len(s)
    order = np.argsort(s, kind="stable")
    head = np.empty(n, dtype=bool)  # places of the order where a group of equals begins
    head[:1] = True
    head[1:] = s[order[1:]] != s[order[:-1]]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    open_, k = np.flatnonzero(~head | ~np.append(head[1:], True)), 1
    while len(open_):
        items = order[open_]
        after = items + k
        key = rank[items] * (n + 1)
        inside = after < n  # the end of the text is smaller than all
        key[inside] += rank[after[inside]] + 1
        by = np.argsort(key)
        items, key = items[by], key[by]
        order[open_] = items
        fresh = np.append(True, key[1:] != key[:-1])
        rank[items] = np.maximum.accumulate(np.where(fresh, open_, 0))
        open_ = open_[~fresh | ~np.append(fresh[1:], True)]
        k *= 2
    return order


def _sorted_lms(s: np.ndarray, lms: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The LMS suffixes in order, given all suffixes in the order of a first round of induction."""
    is_lms = np.zeros(len(s), dtype=bool)
    is_lms[lms] = True
    order = first[is_lms[first]]
    names = _names(s, lms, order)
    if names.max() + 1 == len(lms):
        return order
    return lms[_doubled(names)]


def suffix_array(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, suffix array) of the strings data[offsets[i]:offsets[i + 1]], each followed by its separator.

    In ``text`` string i starts at offsets[i] + i; separator i is the number i and byte b is b plus the number of strings.
    """
    m = len(offsets) - 1
    text = np.empty(len(data) + m, dtype=np.int64)
    ends = offsets[1:] + np.arange(m)
    inner = np.ones(len(text), dtype=bool)
    inner[ends] = False
    text[inner] = data.astype(np.int64) + m
    text[ends] = np.arange(m)
    bucket = np.where(inner, text - m + 1, 0).astype(np.int16)
    if not m:
        return text, text
    is_s = _types(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    buckets = _Buckets(bucket, is_s)
    if not len(lms):
        return text, buckets.induce(lms)
    return text, buckets.induce(_sorted_lms(text, lms, buckets.induce(lms)))


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the text, in text order: the suffix before it in the array (-1: none), and their common prefix.

    Only where the characters before the two differ is a prefix compared; elsewhere it is one
    less than that of the place before.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    left = before > 0
    left[0] = False
    same = np.zeros(n, dtype=bool)
    same[left] = text[at[left] - 1] == text[before[left] - 1]
    # the place before must be compared with the place before its partner
    same[1:] &= before[:-1] == before[1:] - 1
    start = np.flatnonzero(~same)
    length = np.zeros(n, dtype=np.int64)
    open_ = start[before[start] >= 0]
    k = 0
    while len(open_):
        open_ = open_[(open_ + k < n) & (before[open_] + k < n)]
        open_ = open_[text[open_ + k] == text[before[open_] + k]]
        k += 1
        length[open_] = k
    last = np.maximum.accumulate(np.where(same, 0, at))
    return before, np.where(same, length[last] - (at - last), length)
