"""Token alignment beside a plain one over whole tables, and its edges."""

import hashlib
import os
import random
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import queries, token_alignment

SF = "/root/testdata/sf0.001"
needs_vocabularies = pytest.mark.skipif(not os.path.isfile(token_alignment.BYTE_LEVEL), reason="no tokenizer files")
pytestmark = needs_vocabularies


def plain_alignment(docs):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each (doc_id, text), token by token."""
    a_model = Tokenizer.from_file(token_alignment.BYTE_LEVEL)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=token_alignment.PIECES)
    symbol = token_alignment.byte_symbols()
    found, holds = [], Counter()
    for doc, text in docs:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        bytes_a = [bytes(symbol[c] for c in a_model.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:-1], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, b_model.id_to_piece(i)) for i in b)]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode() if text else True:
            found.append((doc, [], [], [], Counter()))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
        shared = sorted(set(ends_a) & set(ends_b))
        groups, links = [], Counter()
        for start, end in zip([0, *shared], shared):
            own = a[bisect_right(ends_a, start):bisect_right(ends_a, end)]
            other = b[bisect_right(ends_b, start):bisect_right(ends_b, end)]
            groups.append((own, other))
            links.update((x, y) for x in own for y in other)
        holds.update(links.keys())
        found.append((doc, a, b, groups, links))
    top = defaultdict(int)
    for (x, _), n in holds.items():
        top[x] = max(top[x], n)
    return [(doc, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if holds[p] == top[p[0]]),
             sum(n * holds[p] for p, n in links.items()),
             ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)) for doc, a, b, groups, links in found]


def odd_texts():
    rng = random.Random(11)
    marks = ["a", "é", "日本", " ", "  ", "\n", "\t", "▁", "😀", "1", "=", "tion", "'s", "\x00", "ﬁ", "<|endoftext|>", "<s>", "</s>", "ß", "the "]
    noise = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    return [None, "", " ", "\n", "x", "the cat", "the cat", "▁", "a" * 5000, "=-" * 3000, " the" * 2000, "日本語のテキスト" * 300,
            "naïve café " * 50, "tab\tand\r\nline", *noise]


def test_alignment_equals_a_plain_one(spark):
    docs = [*enumerate(odd_texts()), (None, "no id"), (3, "twice the id")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("taken") for c in ("block", "codes", "n_a", "groups", "doc")})
    want = sorted(plain_alignment(docs), key=repr)
    for block_bytes in (300, 8 << 20):  # many blocks, and one per task
        got = token_alignment.align_tokens(frame, block_bytes=block_bytes).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert sum(r[1] == 0 for r in want) > 2 and any(r[3] != r[1] for r in want)
    assert token_alignment.align_tokens(frame.filter("false")).count() == 0
    assert {r.n_a for r in token_alignment.align_tokens(frame.filter("text is null or text = ''")).collect()} == {0}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_equals_a_plain_alignment(spark):
    got = queries.QUERIES["op13_token_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in plain_alignment(docs)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_both_libraries_give_the_ids_of_the_byte_level_vocabulary():
    own = Tokenizer.from_file(token_alignment.BYTE_LEVEL)
    own.encode_special_tokens = True
    model = token_alignment.byte_level(token_alignment.BYTE_LEVEL)
    texts = [" " + t for t in odd_texts() if t] + ["".join(map(chr, range(s, s + 500))) for s in (1, 0x300, 0x2000, 0x3000, 0xFE00, 0x1F300)]
    assert model.encode(texts) == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_windows_are_aligned_once_and_never_mixed_up(monkeypatch):
    made = []
    plain = token_alignment.Memo._align

    def seen(self, a, first_a, b, first_b):
        made.extend(tuple(x.tolist()) for x in np.split(a, first_a[1:]))
        plain(self, a, first_a, b, first_b)

    monkeypatch.setattr(token_alignment.Memo, "_align", seen)
    fresh = token_alignment.Memo(token_alignment.byte_level(token_alignment.BYTE_LEVEL), token_alignment.pieces(token_alignment.PIECES))
    monkeypatch.setattr(token_alignment, "memo", lambda *_: fresh)
    texts = pa.array(["the cat sat", "the cat sat on the cat", "a cat"])
    first = token_alignment.Slice(texts, token_alignment.BYTE_LEVEL, token_alignment.PIECES, False)
    assert len(made) == len(set(made)) == 5  # the, cat, sat, on, a
    assert token_alignment.Slice(texts, token_alignment.BYTE_LEVEL, token_alignment.PIECES, False).groups == first.groups and len(made) == 5
    # one hash for all windows: told apart by their ids
    monkeypatch.setattr(token_alignment, "mix", lambda x: x * 0)
    again = token_alignment.Slice(texts, token_alignment.BYTE_LEVEL, token_alignment.PIECES, False)
    assert again.groups == first.groups
    # an emptied memo gives the same
    made.clear()
    monkeypatch.undo()
    monkeypatch.setattr(token_alignment.Memo, "_align", seen)
    monkeypatch.setattr(token_alignment, "memo", lambda *_: fresh)
    monkeypatch.setattr(token_alignment, "MEMO", 1)
    assert token_alignment.Slice(texts, token_alignment.BYTE_LEVEL, token_alignment.PIECES, False).groups == first.groups and len(made) == 5
