"""Plain, slow versions of the operators, from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
SPACE = " \t\n\x0b\f\r"


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def contaminated(text: str | None, items: list[tuple], window: int = 10) -> tuple[int, int, list[str]]:
    """Words, hit words, and the items that occur."""
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for p in range(len(own) - size + 1):
                if own[p:p + size] == w[i:i + size]:
                    hit.update(range(p, p + size))
                    if item is not None:
                        found.add(str(item))
    return len(own), len(hit), sorted(found)


def kept_lines(docs: list[tuple]) -> list[tuple[str, int, int]]:
    """(kept text, lines, dropped lines) of each (doc_id, text)."""
    def key(line: str) -> str:
        return lower(line.strip(SPACE))

    order = lambda d: (d is not None, d or 0)
    held = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(d)
    last = {k: max(v, key=order) for k, v in held.items() if len(v) >= 3}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == d]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def bag(text: str | None, size: int = 5) -> Counter:
    w = words(text)
    return Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def classes(docs: list[tuple], similarity: float = 0.8) -> dict:
    """Smallest id of each document's class, by comparing all pairs that share a shingle."""
    bags = {d: bag(t) for d, t in docs}
    sizes = {d: sum(b.values()) for d, b in bags.items()}
    having, parent = defaultdict(list), {d: d for d in bags}
    for d, b in bags.items():
        for s in b:
            having[s].append(d)

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for x, y in {(x, y) for group in having.values() for x in group for y in group if x < y}:
        both = sum((bags[x] & bags[y]).values())
        if both / (sizes[x] + sizes[y] - both) >= similarity and root(x) != root(y):
            a, b = sorted((root(x), root(y)))
            parent[b] = a
    return {d: root(d) for d in bags}


def without_repeats(docs: list[tuple], length: int = 100) -> list[tuple[int, int, int, str]]:
    """(bytes, removed, spans, sha of the rest) of (doc_id, text) rows that are in order."""
    seen, out = set(), []
    for _, t in docs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i:i + length]
            if piece in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(piece)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone, strict=True) if not g))))
    return out


def best_fit(pieces: list[tuple[int, object, object]], capacity: int) -> list[int]:
    """The bin of each (size, source, cluster) in order: the tightest bin without either."""
    bins: list[list] = []
    out = []
    for size, source, cluster in pieces:
        fits = [(b[0], n) for n, b in enumerate(bins) if b[0] >= size
                and (source is None or source not in b[1]) and (cluster is None or cluster not in b[2])]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([capacity, set(), set()])
        bins[n][0] -= size
        bins[n][1].add(source)
        bins[n][2].add(cluster)
        out.append(n)
    return out
