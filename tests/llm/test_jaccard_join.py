"""The Jaccard join beside all pairs, and its parts."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import jaccard_join
from clickloom.llm.grouping import grouped, whole_groups


def plain_sets(docs, shingle):
    out = []
    for _, text in docs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()  # no other white space in these texts
        out.append({tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set()))
    return out


def plain_components(docs, shingle=5, percent=80):
    """(doc, n_shingles, component) by all pairs."""
    sets = plain_sets(docs, shingle)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = find(i)
        least[r] = min(least.get(r, (True, None)), (doc is None, doc), key=lambda x: (x[0], x[1] or 0))
    return sorted(((doc, len(sets[i]), least[find(i)][1]) for i, (doc, _) in enumerate(docs)), key=repr)


def varied(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        what = rng.randrange(3)
        at = rng.randrange(len(out) + 1)
        if what == 0:
            out.insert(at, f"n{rng.randrange(10**6)}")
        elif len(out) > 1:
            at = min(at, len(out) - 1)
            if what == 1:
                del out[at]
            else:
                out[at] = f"n{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(55)]
    found = [None, "", " \t\n", "one", "ONE", "one two", "Two one", "a b c d", "a b c d e", "a b c d e f", "x a b c d e f y", "É b c d e", "é b c d e"]
    for length in (6, 9, 12, 16, 22, 30, 60, 160):
        for _ in range(3):
            base = [rng.choice(vocabulary) for _ in range(length)]
            for _ in range(6):
                found.append(" ".join(varied(rng, base, rng.randrange(0, max(2, length // 25) + 1))))
            found.append("  ".join(base).upper())
    for _ in range(25):  # many share a passage and nothing else
        found.append(" ".join([rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))] + passage))
    hot = [rng.choice(vocabulary) for _ in range(200)]  # near copies, many of them apart from each other
    for _ in range(40):
        found.append(" ".join(varied(rng, hot, 7)))
    found += [" ".join(hot)] * 12
    return [(None if i == 20 else i if i != 30 else 29, t) for i, t in enumerate(found)]


@pytest.mark.parametrize("limit", [None, 0, 12])
def test_components_equal_all_pairs(spark, docs, limit, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ELEMENTS", 1500)  # several blocks in the long lists
    monkeypatch.setattr(jaccard_join, "SHORT", 12)
    monkeypatch.setattr(jaccard_join, "HOT", 20)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("taken") for c in ("doc", "content", "size", "element", "root", "cells")})
    got = jaccard_join.jaccard_components(frame, limit=limit).select("doc", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(docs)


def test_other_similarity_and_empty_tables(spark, docs):
    some = docs[:80]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    got = jaccard_join.jaccard_components(frame, shingle=3, percent=55).select("doc", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(some, 3, 55)
    assert jaccard_join.jaccard_components(frame.filter("false")).count() == 0
    assert jaccard_join.jaccard_components(frame.filter("doc_id < 3")).select("component_id").distinct().count() == 3


def test_subsets_meet_whatever_links():
    for s in range(1, 19):
        for t in range(s, 19):
            o = jaccard_join.needed(s, t)
            if o <= s:
                assert 100 * o >= 80 * (s + t - o) and 100 * (o - 1) < 80 * (s + t - o + 1)
                assert o in jaccard_join.subset_sizes(s, 18, 80) and o in jaccard_join.subset_sizes(t, 18, 80)


def test_boundary_follows_the_lists(spark):
    """Where the elements of small sets are in long lists, subsets are the cheaper way; where they are rare, lists are."""
    def limit(texts):
        found = jaccard_join.facts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", 5)
        small = found.filter("small is not null and cells is null").dropDuplicates(["content"])
        return jaccard_join.boundary(small, jaccard_join.element_counts(found), 80)

    rng = random.Random(2)
    rare = [" ".join(f"v{rng.randrange(10**9)}" for _ in range(16)) for _ in range(300)]
    common = [" ".join([f"c{j}" for j in range(14)] + [f"v{i}"]) for i in range(300)]
    assert limit(rare) < 9 <= limit(common)


def test_one_foreign_member_costs_one_pass(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ELEMENTS", 100)
    rows = [(7, c, 10, 0, True, 1 if c else 2) for c in range(2000)]
    members = spark.createDataFrame(rows, "element long, content long, size long, place long, index boolean, root long")
    cells = jaccard_join.dealt(members)
    assert cells.filter("root = 1").count() == 1999  # each once, however many blocks
    assert cells.filter("root = 2").count() <= 2000 * 10 // 100 + 1


def test_groups_of_a_stream():
    batches = [pa.RecordBatch.from_pydict({"k": k, "j": j, "v": v}) for k, j, v in (
        ([1, 1, 2], [0, 0, 0], [1, 2, 3]), ([], [], []), ([2, 2, 2], [0, 1, 1], [4, 5, 6]), ([3], [1], [7]))]
    batches = [b if b.num_rows else batches[0].slice(0, 0) for b in batches]
    assert [g.column("v").to_pylist() for g in grouped(iter(batches), ["k", "j"])] == [[1, 2], [3, 4], [5, 6], [7]]
    whole = [(t.column("v").to_pylist(), e.tolist()) for t, e in whole_groups(iter(batches), "k")]
    assert whole == [([1, 2], [2, 2]), ([3, 4, 5, 6], [4] * 4), ([7], [1])]


def test_sets_are_told_by_their_elements():
    sets = jaccard_join.Sets(pa.array(["a b c d e f", "f a b c d e", "a b c d e a b c d e", None, "a  b", "A B"]), 5)
    assert sets.size.tolist() == [2, 2, 5, 0, 1, 1] and sets.content[4] == sets.content[5]
    assert len(np.unique(sets.content)) == 5
