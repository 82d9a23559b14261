"""Edge cases of every operator, and whole queries beside plain versions."""

import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import plain
from clickloom.llm import (
    best_fit, chat_format, components, dart_minhash, decontaminate, exact_top_k, html_text, language_id, line_dedup, lm_score,
    near_dedup, ppm, queries, substring_dedup, suffix_array,
)
from clickloom.llm.bytework import Words, grams, span_hashes, window_min
from clickloom.llm.filters import bitmap_of, in_bitmap

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

random.seed(5)
PROSE = " ".join(random.choice("alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu 12 x7".split()) for _ in range(400))
LONG = " ".join(f"w{i % 4099} v{i % 911}" for i in range(30_000))
PASSAGE = "One two three four five six seven eight nine ten, eleven twelve"
LINE = "  All Rights reserved by the makers.  "

#: doc_id, text: null and empty parts, a very long text, ties, repeated rows, near copies, shared lines and passages
DOCS = [
    (1, f"{PROSE}\n{LINE}\nshort"), (2, f"{PROSE}\n{LINE.upper()}\nshort"), (3, f"{PROSE.replace('kappa', 'KAPPA')} tail\n{LINE}"),
    (4, None), (5, ""), (6, LONG), (7, f"intro {PASSAGE} outro"), (7, f"intro {PASSAGE} outro"), (8, "\n\n"), (9, "... !!! ?"),
    (10, f"x {PASSAGE[:30]}"), (None, f"{PROSE} with no id\n{LINE}"), (11, "a" * 350), (12, "ab" * 100 + "a" * 150), (13, "x"),
    (14, f"{LONG} and more"), (15, "tiny item"),
]
ITEMS = [(1, PASSAGE), (2, "tiny item"), (3, None), (4, "..."), (None, PASSAGE), (5, PASSAGE), (10, PROSE[:200]), (10, PROSE[:200])]

CLASHING = ("row_key", "anchor", "h1", "lost_doc", "lang_pred", "n_lines", "hit_doc", "gone", "copy", "text_")


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame([(d, t, "en" if d else None, f"src{(d or 0) % 3}" if d != 5 else None, len(t or "")) for d, t in DOCS],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.lit("taken") for c in CLASHING})


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def tuples(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- helpers --------------------------------------------------------------------------------------------------------


def test_equal_content_has_equal_hashes_wherever_it_lies():
    data = np.frombuffer(b"--hello----hello-hellp", dtype=np.uint8)
    h = span_hashes(data, np.array([2, 11, 17]), np.array([7, 16, 22]))
    assert h[0] == h[1] != h[2]
    assert len(set(span_hashes(data, np.array([0, 0, 0]), np.array([0, 1, 2])))) == 3


def test_words_and_window_minimum():
    w = Words(pa.array(["Ab, cdé 1", None, "", "x"]))
    assert [w.text(i) for i in range(4)] == ["ab", "cdé", "1", "x"] and w.first.tolist() == [0, 3, 3, 3, 4]
    values = np.random.default_rng(0).integers(0, 99, 50).astype(np.uint64)
    assert window_min(values, 7).tolist() == [min(values[i:i + 7]) for i in range(44)]
    assert len(grams(w.hashes, 9)) == 0


def test_bitmap_has_all_it_was_built_from(spark):
    values = [0, 1, 32768, 32769, (1 << 27) - 1, 1 << 27, -1, -(1 << 40)]
    bits = bitmap_of(spark.createDataFrame([(v,) for v in values], "v long"), F.col("v"))
    assert in_bitmap(bits, np.array(values, dtype=np.int64).view(np.uint64)).all()
    assert in_bitmap(bits, np.arange(2, 30000, dtype=np.uint64)).sum() == 0


def test_components(spark):
    ids = [zlib.crc32(str(i).encode()) for i in range(60)]
    edges = [(ids[i], ids[i + 1]) for i in range(28)] + [(ids[40], ids[i]) for i in range(41, 55)] + [(ids[41], ids[42]), (ids[58], ids[58])]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.root].add(r.node)
    assert sorted(map(len, groups.values())) == [15, 29] and all(k in v for k, v in groups.items())
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ------------------------------------------------------------------------------------------------


def test_contaminated_spans_equal_a_plain_search(docs, items, none):
    got = decontaminate.contaminated_spans(docs, items).select(
        "doc", "n_words", decontaminate.n_hit().alias("n_hit"), "items").collect()
    short = [(d, t) for d, t in DOCS if len(t or "") < 10_000]
    want = sorted(((d, *plain.contaminated(t, ITEMS)) for d, t in short), key=repr)
    assert sorted(((r.doc, r.n_words, r.n_hit, r["items"]) for r in got if r.doc not in (6, 14)), key=repr) == want
    assert {r.n_words for r in got if r.doc in (6, 14)} == {60_000, 60_002} and len(got) == len(DOCS)
    assert decontaminate.contaminated_spans(none, items).count() == 0
    assert {r.n for r in decontaminate.contaminated_spans(docs, items.filter("false")).select(
        decontaminate.n_hit().alias("n")).collect()} == {0}


def test_random_windows_are_all_found(spark):
    rng = random.Random(1)
    some = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(80)]
    bench = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 16)))) for i in range(12)]
    got = decontaminate.contaminated_spans(spark.createDataFrame(some, "doc_id long, text string"),
                                           spark.createDataFrame(bench, "item_id long, text string"))
    got = {r.doc: (r.n_words, r.n, r["items"]) for r in got.withColumn("n", decontaminate.n_hit()).collect()}
    assert got == {d: plain.contaminated(t, bench) for d, t in some}


def test_clean_documents_keep_all_columns(docs, items):
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(
        d for d, t in DOCS if len(t or "") > 10_000 or not plain.contaminated(t, ITEMS)[1])


# --- top-k ----------------------------------------------------------------------------------------------------------


def test_top_k_equals_all_products(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-3, 3)) / 256 for _ in range(4)]) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan")] * 4), (304, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4),
             (50, rows[50][1]), (350, [0.0] * 4), (400, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit(1))
    got = exact_top_k.exact_top_k(frame, F.col("vec_id") % 50 == 0, 5, block_rows=64, group_rows=3)
    usable = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q, a in usable:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(b) == len(a))[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert tuples(got) == sorted(want, key=repr)
    assert exact_top_k.exact_top_k(frame.filter("false"), F.lit(True)).count() == 0


def test_threshold_search_stops_early():
    rng = np.random.default_rng(0)
    block = np.round(rng.normal(size=(4000, 3)) * 256)
    lists = np.ascontiguousarray(np.argsort(block, axis=0, kind="stable").T)
    ids = np.arange(4000)
    for q in np.round(rng.normal(size=(20, 3)) * 256):
        best = np.lexsort((ids, -(block @ q)))[:6]
        assert exact_top_k.threshold_search(q, -1, ids, block, lists, 6) == [(int((block @ q)[i]), int(i)) for i in best]


# --- language models ------------------------------------------------------------------------------------------------


def test_frozen_trie_equals_the_growing_one():
    texts = ["abracadabra", "Abra", "", "cadabra éé", "zzz"] * 3 + ["bra bra"]
    for order in (2, 3, 5):
        grown = ppm.GrowingTrie(order)
        for t in texts:
            context = (ppm.START,) * order
            for s in grown.symbols(t):
                grown.learn(context, s)
                context = (*context[1:], s)
        keys, counts = ppm.counted(ppm.text_grams(pa.array(texts), order)[0])
        trie = ppm.ContextTrie(ppm.levels_of(keys, counts, order))
        for t in ["abra", "xyz é", "", "zzzz"]:
            want = grown.text_log2_prob(t, False)
            assert trie.log2_prob(ppm.text_grams(pa.array([t]), order)[0]).sum() == pytest.approx(want, rel=1e-9)


def test_probabilities_of_all_symbols_add_up_to_one():
    keys, counts = ppm.counted(ppm.text_grams(pa.array(["abracadabra", "banana", ""]), 3)[0])
    trie = ppm.ContextTrie(ppm.levels_of(keys, counts, 3))
    for context in (b"abr", b"zzz", b"ana", b"\xff\xffa"):
        base = 0
        for b in context:
            base = (base << 9) | b
        assert np.exp2(trie.log2_prob((base << 9) | np.arange(257))).sum() == pytest.approx(1.0)


def test_scores_of_edge_cases(docs, none):
    got = lm_score.score_texts(docs, F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False)), order=3, block_bytes=4000).collect()
    assert len(got) == len(DOCS)
    train, trie = Counter(), ppm.GrowingTrie(3)
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", plain.lower(t)) + [None]
    for d, t in DOCS:
        if d is not None and d % 2:
            train.update(tokens(t))
            context = (ppm.START,) * 3
            for s in trie.symbols(t or ""):
                trie.learn(context, s)
                context = (*context[1:], s)
    n, v = sum(train.values()), len(train)
    for r in got:
        t = next(t for d, t in DOCS if d == r.doc_id)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens(t)), sum(train[x] > 0 for x in tokens(t)), n)
        base = sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if len(t or "") < 5000:
            assert r.score == pytest.approx(trie.text_log2_prob(t or "", False) * math.log10(2), rel=1e-6)
    assert lm_score.score_texts(none, F.lit(True)).count() == 0
    untrained = lm_score.score_texts(docs.filter("doc_id = 13"), F.lit(False)).first()
    assert untrained.base_score == 0 and untrained.score == pytest.approx(-2 * math.log10(257))


def test_adaptive_scores(docs):
    got = {r.doc_id: r.score for r in lm_score.adaptive_scores(docs.filter("doc_id in (5, 11, 13)"), order=3).collect()}
    assert got[5] == pytest.approx(-math.log10(257)) and got[13] < got[5] and got[11] > -350 * math.log10(257) / 5


@needs_tables
def test_scores_beat_the_base_on_held_out_text(spark):
    rows = queries.QUERIES["op3_lm_score"](spark, "/root/testdata/sf0.01").filter("held_out").agg(
        F.sum("base_score").alias("base"), F.sum("score").alias("score")).first()
    assert rows.score > rows.base


def test_languages(spark, none):
    rng = random.Random(3)
    sounds = {"aa": "ba be bi".split(), "bb": "ko ku ky".split()}
    rows = [(i, " ".join("".join(rng.choice(sounds[lang]) for _ in range(3)) for _ in range(20)), lang)
            for i, lang in enumerate(["aa", "bb"] * 20)]
    rows += [(100, None, "aa"), (101, "123 !!", "bb"), (102, "", None), (None, "kokoku ky", None), (103, "babebi " * 9000, None), (103, "babebi", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"lang_pred": F.lit(1), "score": F.lit(2)})
    model = language_id.train(language_id.training_sample(frame, F.col("doc_id") < 30, "text", "lang"))
    assert model.languages == ["aa", "bb"]
    found = language_id.identify(frame, model)
    assert found.columns == [*frame.columns, "_lang_pred", "_score"]
    for r in found.collect():
        if r.doc_id is not None and r.doc_id < 40:
            assert r._lang_pred == r.lang and 0.5 < r._score <= 1
        elif r.doc_id in (100, 101, 102):
            assert (r._lang_pred, r._score) == ("und", 0)
        else:
            assert r._lang_pred == ("bb" if r.doc_id is None else "aa")
    nothing = language_id.train(language_id.training_sample(none, F.lit(True), "text", "lang"))
    assert {r._lang_pred for r in language_id.identify(frame, nothing).collect()} == {"und"}
    assert language_id.identify(none, model).count() == 0


def test_language_sample_of_copies_and_long_texts(spark):
    def sample(rows, **bounds):
        frame = spark.createDataFrame(rows, "text string, lang string")
        return sorted(tuple(r) for r in language_id.training_sample(frame, F.lit(True), "text", "lang", **bounds).collect())

    texts = spark.createDataFrame([(f"text {i}",) for i in range(60)], "text string").orderBy(F.xxhash64("text"))
    texts = [r.text for r in texts.collect()]
    late = texts[-5:]  # of large hash: thinned by the number of rows, none of them would stay
    assert sample([(t, "aa") for t in late] * 400) == sorted(("aa", t) for t in late)
    # the text of least hash, copied, leaves the others their places
    assert sample([(texts[0], "aa")] * 300 + [(t, "aa") for t in late]) == sorted(("aa", t) for t in [texts[0], *late])
    # whole texts first, then beginnings of longer ones, different ones only
    long = [(c * 50, "bb") for c in "wxyz"]
    assert sample([("short", "bb"), *long, *long], docs_per_language=3, most_chars=20)[0] == ("bb", "short")
    assert sample(long + [("w" * 70, "bb")], most_chars=20) == [("bb", c * 20) for c in "wxyz"]
    assert sample([("a", "bb"), ("b", "bb"), *long], docs_per_language=2, most_chars=20) == [("bb", "a"), ("bb", "b")]
    assert len(sample([("w" * 20, "bb"), *long], docs_per_language=3, most_chars=20)) == 3


@needs_tables
def test_held_out_languages(spark):
    found = queries.QUERIES["op6_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert rows and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


# --- packing --------------------------------------------------------------------------------------------------------


def test_bins_equal_plain_best_fit():
    rng = random.Random(4)
    for _ in range(30):
        pieces = [(rng.choice([0, 1, 3, 7, 20, rng.randint(0, 20)]), rng.choice([None, "a", "b", "c"]), rng.choice([None, None, 1, 2]))
                  for _ in range(rng.randint(1, 80))]
        bins = best_fit.Bins(20)
        got = [bins.put(n, [m for m in (("source", s), ("cluster", c)) if m[1] is not None])[0] for n, s, c in pieces]
        assert got == plain.best_fit(pieces, 20)


def test_packing_places_every_token_once(docs, none):
    rows = best_fit.pack(docs, capacity=512, shard_rows=40).collect()
    size, of = defaultdict(list), {}
    for d, t in DOCS:
        size[d].append(len((t or "").split()))
        of[d] = (f"src{(d or 0) % 3}" if d != 5 else None, " ".join((t or "").lower().split()) or None)
    placed = Counter()
    for r in rows:
        placed[r.doc_id] += r.n_tokens
    assert placed == Counter({d: sum(s) for d, s in size.items()})
    for members in _bins(rows).values():
        at = 0
        for r in sorted(members, key=lambda r: (r.bin_offset, r.n_tokens)):
            assert r.bin_offset == at
            at += r.n_tokens
        assert at == members[0].bin_tokens <= 512
        for k in (0, 1):
            marks = [of[r.doc_id][k] for r in members if of[r.doc_id][k] is not None]
            assert len(marks) == len(set(marks))
    assert best_fit.pack(none).count() == 0


def _bins(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    return bins


@needs_tables
def test_packing_query_is_valid(spark):
    rows = queries.QUERIES["op4_best_fit"](spark, SF).collect()
    source = {r.doc_id: (r.source, len(r.text.split())) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    total = Counter()
    for members in _bins(rows).values():
        assert len({source[r.doc_id][0] for r in members}) == len(members) and sum(r.n_tokens for r in members) <= 2048
        for r in members:
            total[r.doc_id] += r.n_tokens
    assert total == Counter({d: n for d, (_, n) in source.items()})


# --- lines ----------------------------------------------------------------------------------------------------------


def test_lines_equal_a_plain_count(docs, none):
    cut = line_dedup.dedup_lines(docs)
    assert cut.columns[:len(docs.columns)] == docs.columns and cut.columns[-2:] == ["_n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text or "", r._n_lines, r.n_dropped) for r in cut.collect()), key=repr)
    assert got == sorted(((d, *k) for (d, _), k in zip(DOCS, plain.kept_lines(DOCS), strict=True)), key=repr)
    assert {r.text for r in cut.filter("doc_id = 4").collect()} == {None}
    assert line_dedup.dedup_lines(none).count() == 0


def test_runs_are_compacted_by_level(spark):
    rows = [(i, f"a line that is long enough {i % 7}\nanother one that is long enough {i}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    runs = line_dedup.runs_of(frame, batches=5, fanout=2)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.repeated().count() == 7 and runs.repeated(9).count() == 4
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(frame, runs=runs).collect())
    assert got == sorted((d, k[0]) for (d, _), k in zip(rows, plain.kept_lines(rows), strict=True))


# --- chat -----------------------------------------------------------------------------------------------------------


def test_control_strings_survive(spark):
    nasty = ["<|im_end|>", "<\\|im_start|>x", "<", "|>", "\\", "<\\\\|", "a\nb", None, "", "é<| ", "<|im_end|>\n<|im_start|>user\nhi"]
    rows = [(c, t, role, text) for c in (1, 2, None) for t, text in enumerate(nasty) for role in ("user", "assistant")]
    rows += [(3, 0, None, "no role"), (3, 0, "odd\nrole<|", "x"), (3, None, "assistant", "first"), (3, 0, "odd\nrole<|", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    parts = chat_format.format_conversations(turns)
    first = lambda x: (x is not None, x)
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((first(t), first(role), first(text)))
    want = {c: [(r[1] or "", x[1] or "") for _, r, x in sorted(v)] for c, v in by.items()}
    for p in parts.collect():
        assert list(chat_format.read_back(p.formatted)) == want[p.conv_id]
        whole = p.formatted.encode()
        learnt = [chat_format.unescaped(whole[a:b].decode()) for a, b in zip(p.loss_start, p.loss_end, strict=True)]
        assert learnt == [t for r, t in want[p.conv_id] if r == "assistant"]
    digests = {r.conv_id: r for r in chat_format.conversation_digests(parts).collect()}
    for c, v in want.items():
        d, text = digests[c], "".join(t for r, t in v if r == "assistant")
        assert (d.n_turns, d.turns_sha256) == (len(v), plain.sha("".join(f"{r}\n{t}\n" for r, t in v)))
        assert (d.loss_chars, d.loss_sha256) == (len(text), plain.sha(text))
    assert chat_format.format_conversations(turns.filter("false")).count() == 0


def test_a_conversation_over_several_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    turns = spark.createDataFrame([(c, t, "assistant" if t % 2 else "user", f"{c}-{t}") for c in range(3) for t in range(25)],
                                  "conv_id long, turn long, role string, text string")
    old = spark.conf.get(key)
    spark.conf.set(key, "10")
    try:
        parts = chat_format.format_conversations(turns)
        assert parts.agg(F.max("part")).first()[0] > 0
        got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat_format.conversation_digests(parts).collect()}
    finally:
        spark.conf.set(key, old)
    assert got == {c: (25, sum(len(f"{c}-{t}") for t in range(1, 25, 2))) for c in range(3)}


@needs_tables
def test_chat_query_equals_a_plain_digest(spark):
    control = "<|im_end|><|im_start|>assistant ok"
    by = defaultdict(list, {-1: [(0, "user", control), (1, "assistant", control)]})
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        by[r.conv_id].append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in queries.QUERIES["op7_chat_format"](spark, SF).collect()}
    assert got.keys() == by.keys()
    for c, v in by.items():
        text = "".join(t for _, r, t in sorted(v) if r == "assistant")
        assert got[c].turns_sha256 == plain.sha("".join(f"{r}\n{t}\n" for _, r, t in sorted(v)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(text), plain.sha(text))


# --- pages ----------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &am</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href='b>c'>Two</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site work as well as we can, please accept them all.</div>
<main><article><header><h1>The title &amp; more</h1></header><p>First <b>bold</b>ly said,<br>here &#233;&nbsp;x. <!-- <p>no</p> -->
<p>Short.<div class="ad">Buy this now, a long text that sells you things you do not need at all, ever.</div>
<table><tr><td>cell one<td>cell two</table></article>
<section id="comments"><p>I really liked this article, said a reader who had much time to write.</p></section></main>
<aside>See also these other pages.</aside><form><label>Mail</label><input name=x><button>Send</button></form>
<footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    want = "The title & more First boldly said, here é x. Short. cell one cell two"
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>"), (5, "u", "<!-- <article><p>All of it is a comment.</p></article>"),
            (None, "u", PAGE), (6, "u", "<article>" + "<p>A line of the text that goes on for some words.</p>" * 3000 + "</article>"),
            (7, "u", "<article><p>unclosed <b>tags <i>all &lt;over&gt;"), (7, "u", "<article><p>unclosed <b>tags <i>all &lt;over&gt;")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("taken"))
    found = html_text.extract_text(frame)
    assert found.columns == ["page_id", "url", "text", "_text"]
    got = defaultdict(list)
    for r in found.collect():
        got[r.page_id].append(r._text)
    assert got[1] == got[None] == [want] and got[2] == got[3] == got[4] == got[5] == [""]
    assert got[6] == [" ".join(["A line of the text that goes on for some words."] * 3000)]
    assert got[7] == ["unclosed tags all <over>"] * 2
    assert html_text.extract_text(frame.filter("false")).count() == 0


def test_elements_without_text():
    body = "<article><p>One line of text.</p>%s<p>More text after it.</p></article><p>And the end of the page, with words enough to stay.</p>"
    want = "One line of text. More text after it."

    def reads(middle, before=""):
        text = html_text.main_text(before + body % middle)
        return text.removesuffix(" And the end of the page, with words enough to stay.")

    # head may be left open, with or without a body tag, and may be followed by text at once
    for head in ("<head><title>T</title><meta charset=utf-8>", "<html><head><title>T</title><script>x</script><body>",
                 "<head><noscript><style>p{}</style><p>no</p></noscript><link rel=a></head>"):
        assert reads("", head) == want
    for tag in ("select", "button", "svg", "iframe", "noscript", "template", "datalist"):
        shown = [f"<{tag} a=b/c>", f"<{tag} a='b' />", f"<{tag}/>", f"<{tag} a>hidden<i>too</i></{tag}>", f"<{tag}>hidden<{tag}>hidden</{tag}>",
                 f"<{tag}><x><z>hidden</x></{tag}>", f"<div><{tag}>hidden</div>", f"<{tag.upper()}>hidden</{tag} >"]
        for middle in shown:
            assert reads(middle) == want, middle
            assert reads(middle, f"<p><{tag}>hidden</{tag}></p>") == want, middle
        assert reads(f"<p>left<{tag}>hidden</{tag}>right.</p>").replace("left right", "leftright") == want.replace(". M", ". leftright. M")
        assert reads(f"<{tag}-group>Shown here.</{tag}-group>") == want.replace(". M", ". Shown here. M")
    assert reads("<svg><svg>hidden</svg>hidden</svg>") == reads("<svg><foreignObject><div>hidden</div>hidden</svg>") == want
    assert reads("<noscript><div><p>hidden</div>hidden</noscript>") == want
    # what stands in these is text of the page
    for tag in ("object", "video", "audio", "canvas"):
        assert reads(f"<{tag} a=b><p>Shown here.</p></{tag}>") == want.replace(". M", ". Shown here. M")
    assert reads("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here.</p>") == want.replace(". M", ". So x=2 here. M")
    # these are closed or run to the end
    for tag in ("script", "style", "title", "textarea"):
        assert reads(f"<{tag}>hidden<p></{tag}>") == reads(f"<{tag} src='x' />") == reads(f"</{tag}>") == want
        assert reads(f"<{tag}>") == "One line of text."


def test_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(150):
        n = rng.randint(1, 7)
        gain = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(inside, gain=gain, edges=edges):
            return sum(-g if k and g < 0 else g if not k and g > 0 else 0 for g, k in zip(gain, inside, strict=True)) + sum(
                w for a, b, w in edges if inside[a] != inside[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_text.source_side(gain, edges)) == pytest.approx(best, abs=1e-6)


@needs_tables
def test_pages_query_reads_whole_articles(spark):
    import html as H
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op8_html_text"](spark, SF).collect():
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        text = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner))
        assert r.text == " ".join(H.unescape(text).split()) and r.n_chars == len(r.text)


# --- near duplicates ------------------------------------------------------------------------------------------------


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    x, y = rng.integers(1, 1 << 60, 400).astype(np.uint64), rng.integers(1, 1 << 60, 100).astype(np.uint64)
    cells = np.concatenate([x, x[:300], y])  # similarity 300 / 500
    sig = dart_minhash.signatures(cells, np.array([0, 400, 800, 800]), 512)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.08 and (sig[2] == 0).all() and (sig[:2] != 0).all()
    half = dart_minhash.signatures(np.concatenate([x[:50], x[:50]]), np.array([0, 50, 100]), 512, np.repeat([1.0, 0.5], 50))
    assert abs((half[0] == half[1]).mean() - 0.5) < 0.08
    tiny = dart_minhash.signatures(x[:1], np.array([0, 1]), 64)
    assert (tiny != 0).all()


def test_near_duplicates_of_edge_cases(docs, none):
    rows = near_dedup.near_duplicates(docs).collect()
    got = {r.doc: r.class_id for r in rows}
    assert len(rows) == len(DOCS) and got[2] == got[3] == got[1] == got[None] == 1 and got[14] == got[6] == 6
    assert all(got[d] == d for d in (4, 5, 8, 9, 7, 10, 11, 12, 13, 15))
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == Counter({d for d, _ in DOCS} - {2, 3, 14, None})
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.one_of_each(none).count() == 0


def test_copies_of_one_text_under_one_id(spark):
    rows = [(1, PROSE), (1, PROSE), (1, f"{PROSE} x"), (2, PROSE), (None, PROSE), (3, None), (3, None)]
    kept = near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in kept) == Counter({1: 1, 3: 2})


def test_a_chain_of_near_copies_in_blocks(spark):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(120)]
    rows = []
    for i in range(90):  # edits that range from slight to many, so that not all pairs are alike
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 9999)}"
        rows.append((i, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain.classes(rows)
    for block in (2048, 7):
        assert {r.doc: r.class_id for r in near_dedup.near_duplicates(frame, block=block).collect()} == want


def test_members_of_one_component_are_not_dealt_to_each_other(spark):
    rows = [(1, i, 0 if i < 5000 else i) for i in range(5003)]  # three members stand outside of a hot bucket's component
    members = spark.createDataFrame(rows, "bucket long, content long, root long").withColumn("size", F.lit(len(rows))).withColumn(
        "bands", F.lit(None)).withColumn("coords", F.lit(None)).withColumn("cells", F.lit(None))
    split = near_dedup.split_buckets(members)
    assert [tuple(r) for r in split.collect()] == [(1, 0, 5000)]
    dealt = near_dedup.deal(members.join(split, "bucket"), 100).collect()
    assert len(dealt) == 5000 + 3 * (1 + 50)
    cells = {}
    for r in dealt:
        cells.setdefault((r.i, r.j), set()).add(r.content)
    assert all(any({a, b} <= c for c in cells.values()) for a in (5000, 5001, 5002) for b in (*range(0, 5000, 97), 5000, 5001, 5002))
    # no component holds more than one member: every two of them meet
    lone = members.withColumn("root", F.col("content")).filter("content < 300").withColumn("size", F.lit(300))
    met = {}
    for r in near_dedup.deal(lone.join(near_dedup.split_buckets(lone), "bucket"), 40).collect():
        met.setdefault((r.i, r.j), set()).add(r.content)
    pairs = {(a, b) for c in met.values() for a in c for b in c if a < b}
    assert len(pairs) == 300 * 299 // 2


def test_a_center_of_many_pairs_is_repeated(spark):
    cells = spark.createDataFrame([(i, [*range(9), 100 + i % 3]) for i in range(200)] + [(999, [5000])], "content long, cells array<long>")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 200)] + [(999, 0), (1, 999)], "a long, b long")
    got = sorted(tuple(r) for r in near_dedup.verified(pairs, cells, 0.8, per_task=10).collect())
    assert got == [(i, 0) for i in range(1, 200)]  # nine of eleven shingles shared, or all


def test_the_screen_of_near_dedup_is_a_bound():
    rng = np.random.default_rng(3)
    bags = [np.unique(rng.integers(-2 ** 62, 2 ** 62, 300))]
    for i in range(60):
        own = bags[0].copy()
        own[:i] = rng.integers(-2 ** 62, 2 ** 62, i)
        bags.append(own[: 300 - i // 3])
    size, bins = near_dedup._histograms(pa.array([b.tolist() for b in bags], pa.list_(pa.int64())))
    assert size.tolist() == [len(b) for b in bags] and (bins.sum(axis=1) == size).all()
    for i, a in enumerate(bags):
        for j, b in enumerate(bags):
            assert np.minimum(bins[i], bins[j]).sum() >= len(np.intersect1d(a, b))


@needs_tables
def test_near_duplicate_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in queries.QUERIES["op9_near_dedup"](spark, SF).collect()}
    assert got == plain.classes(rows)


# --- substrings -----------------------------------------------------------------------------------------------------


def test_suffix_arrays():
    rng = random.Random(9)
    for _ in range(200):
        strings = [bytes(rng.randrange(rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        strings += strings[:1]
        at = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
        text, order = suffix_array.suffix_array(np.frombuffer(b"".join(strings), dtype=np.uint8), at)
        whole = text.tolist()
        assert order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
        before, common = suffix_array.permuted_common_prefixes(text, order)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
            k = 0
            while max(a, b) + k < len(whole) and whole[a + k] == whole[b + k]:
                k += 1
            assert before[b] == a and common[b] == k


def test_suffix_arrays_scan_no_entry_in_python():
    rng = random.Random(13)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(40)]
    strings = [" ".join(rng.choice(words) for _ in range(25)).encode() for _ in range(200)]
    strings += [strings[0] * 9, strings[0] * 7, b"ab" * 40, b"aab" * 30, b"a" * 60]
    at = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    lines = 0

    def count(frame, event, _):
        nonlocal lines
        lines += event == "line"
        return count if frame.f_code.co_filename == suffix_array.__file__ else None

    before = sys.gettrace()
    sys.settrace(count)
    text, order = suffix_array.suffix_array(np.frombuffer(b"".join(strings), dtype=np.uint8), at)
    sys.settrace(before)
    whole = text.tolist()
    assert order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    assert lines < len(whole) / 2


def test_strings_without_a_fellow_go_to_no_suffix_array(monkeypatch):
    length, rng = 12, random.Random(14)
    made = lambda n: bytes(rng.randrange(97, 101) for _ in range(n))
    shared, other = made(30), made(30)
    groups = {1: [made(12)], 2: [b := made(12), b, b, b], 3: [made(12), made(12)], 4: [made(20)], 5: [shared, made(9) + shared[3:22]],
              6: [made(12)], 7: [made(12), made(12), b := made(12), b], 8: [made(12), other, other[:12]], 9: [made(12)]}
    listed = [(k, x, 40 - i, 100 * k + i, 1000 * k, len(x) - length + 1) for k, some in groups.items() for i, x in enumerate(some)]
    listed.sort(key=lambda r: (r[0], r[2]))
    table = pa.table({c: pa.array(x, pa.binary() if c == "bytes" else pa.int64()) for c, x in zip("anchor bytes doc ident start n".split(), zip(*listed, strict=True), strict=True)})
    want, seen = set(), {}
    for k, x, doc, ident, start, n in sorted(listed, key=lambda r: r[2:5]):
        for i in range(n):
            at = (k, x[i:i + length])
            if seen.setdefault(at, (doc, ident, start + i)) != (doc, ident, start + i):
                want.update((doc, ident, start + i + j) for j in range(length))
    sorted_bytes, plain_array = [], suffix_array.suffix_array
    monkeypatch.setattr(substring_dedup, "suffix_array", lambda data, at: sorted_bytes.append(data.tobytes()) or plain_array(data, at))
    for rows in (1, 2, 3, 100):
        for shard in (10, 60, 10_000):
            sorted_bytes.clear()
            got = set()
            for batch in substring_dedup.sorted_repeats(iter(table.to_batches(max_chunksize=rows)), length, shard):
                for r in batch.to_pylist():
                    got.update((r["doc"], r["ident"], r["start"] + j) for j in range(r["n"]))
            assert got == want
            arrays = b"|".join(sorted_bytes)
            assert not any(groups[k][0] in arrays for k in (1, 2, 4, 6, 9))
            assert len(arrays.replace(b"|", b"")) == sum(len(x) for k in (3, 5, 7, 8) for x in groups[k]) - length  # of 7, one repeat is told before


def _removed(frame, **options):
    rows = substring_dedup.dedup_substrings(frame, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.starts), plain.sha(bytes(r.kept))) for r in rows), key=repr)


def test_substrings_of_edge_cases(docs, none):
    want = plain.without_repeats(sorted({(d, t) for d, t in DOCS}, key=lambda x: (x[0] is not None, x[0] or 0)))
    byid = dict(zip(sorted({d for d, _ in DOCS}, key=lambda d: (d is not None, d or 0)), want, strict=True))
    got = _removed(docs)
    assert got == sorted(((d, *byid[d]) for d, _ in DOCS), key=repr)
    assert substring_dedup.dedup_substrings(none).count() == 0


def test_random_substrings_with_hot_anchors(spark):
    rng = random.Random(10)
    shared = ["".join(rng.choice("abcd") for _ in range(rng.randint(60, 260))) for _ in range(4)]
    rows = [(i, "".join(rng.choice([*shared, "".join(rng.choice("abcd") for _ in range(rng.randint(0, 80)))]) for _ in range(rng.randint(0, 5))))
            for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = sorted(((d, *w) for (d, _), w in zip(rows, plain.without_repeats(rows), strict=True)), key=repr)
    assert _removed(frame) == want
    assert _removed(frame, most_pieces=2, shard_bytes=3000) == want  # anchors routed string by string, many small arrays


@needs_tables
def test_substring_query_equals_a_plain_search(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = [tuple(r) for r in queries.QUERIES["op10_substring_dedup"](spark, SF).orderBy("doc_id").collect()]
    assert got == [(d, *w) for (d, _), w in zip(rows, plain.without_repeats(rows), strict=True)]


# --- pipeline -------------------------------------------------------------------------------------------------------


@needs_tables
def test_pipeline_equals_plain_stages(spark):
    import corpus_pipeline

    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    rows = [(d, k[0], s) for (d, _, s), k in zip(rows, plain.kept_lines([r[:2] for r in rows]), strict=True)]
    own = plain.classes([r[:2] for r in rows])
    rows = [r for r in rows if own[r[0]] == r[0]]
    windows = {tuple(w[i:i + 10]) for _, t in bench for w in [plain.words(t)] for i in range(len(w) - 9)}
    rows = [r for r in rows for w in [plain.words(r[1])] if not any(tuple(w[i:i + 10]) in windows for i in range(len(w) - 9))]
    placed = corpus_pipeline.run(spark, SF).collect()
    total = Counter()
    for r in placed:
        total[r.doc_id] += r.n_tokens
    assert dict(total) == {d: len(t.split()) for d, t, _ in rows}
    source = {d: s for d, _, s in rows}
    for members in _bins(placed).values():
        assert sum(r.n_tokens for r in members) <= 2048 and len({source[r.doc_id] for r in members}) == len(members)


def test_pipeline_of_edge_cases(spark, docs, none, items, tmp_path):
    import corpus_pipeline

    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for start, some in ((docs, True), (none, False)):
        frame = start
        for name, step in corpus_pipeline.STAGES:
            frame = step(spark, frame, str(tmp_path))
            if name != "best_fit":
                assert frame.columns == docs.columns
        assert bool(frame.count()) == some


def test_null_sizes_are_packed_as_nothing(spark):
    docs = spark.createDataFrame([(1, "a b", None, 2048), (2, "c", None, None), (3, "d", None, 5)], "doc_id long, text string, source string, size int")
    placed = best_fit.pack(docs, size=F.col("size")).collect()
    assert {(r.doc_id, r.n_tokens) for r in placed} == {(1, 2048), (2, 0), (3, 5)} and max(r.bin_tokens for r in placed) == 2048


def test_first_stage_of_the_pipeline_without_labels(spark):
    import corpus_pipeline

    rows = [(1, PROSE, None), (2, "1234 !", None), (3, None, None), (4, "", None), (5, "чистый текст", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.known_language(spark, docs, "")
    assert {(r.doc_id, r.lang) for r in kept.collect()} == {(1, None), (5, None)} and kept.columns == docs.columns
    labelled = docs.unionByName(spark.createDataFrame([(6, PROSE, "en"), (7, "ещё один чистый текст", "ru")], docs.schema))
    kept = corpus_pipeline.known_language(spark, labelled, "")
    assert {(r.doc_id, r.lang) for r in kept.collect()} == {(1, "en"), (5, "ru"), (6, "en"), (7, "ru")}
    assert corpus_pipeline.known_language(spark, docs.filter("false"), "").count() == 0


def test_strings_of_a_flooded_text_are_cut_in_bounded_memory():
    """2 MB whose every string is routed one by one: 200 MB come out, far less is held at a time."""
    import tracemalloc

    size, length = 2 << 20, 100
    text = bytes(np.random.default_rng(1).integers(97, 123, size, dtype=np.uint8)).decode()
    wanted = [[{"start": 0, "n": size - length + 1, "anchor": 5, "kind": substring_dedup.STRINGS}], [{"start": 1, "n": 3, "anchor": 9, "kind": substring_dedup.PIECE}]]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64()), ("anchor", pa.int64()), ("kind", pa.int32())]))
    part = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([11, 12]), pa.array([text, "x" * 300]), pa.array(wanted, kind)],
                                      names=["doc", "ident", "text", "wanted"])
    tracemalloc.start()
    strings, rows, whole = set(), 0, 0
    for batch in substring_dedup.cut_pieces(part, length):
        rows += batch.num_rows
        whole += batch.column("bytes").nbytes
        first, last = batch.slice(0, 1).to_pylist()[0], batch.slice(batch.num_rows - 1, 1).to_pylist()[0]
        for r in (first, last):
            source = text if r["doc"] == 1 else "x" * 300
            assert r["bytes"].decode() == source[r["start"]:r["start"] + r["n"] + length - 1] and (r["n"] == 1) == (r["doc"] == 1)
        strings.update(batch.column("anchor").to_numpy()[:50].tolist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == size - length + 2 and whole > 200 << 20 and len(strings) > 50
    assert peak < 300 << 20
