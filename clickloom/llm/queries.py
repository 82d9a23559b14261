"""One query per operator over its whole table, and DuckDB SQL where SQL can state the result."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    best_fit, chat_format, decontaminate, exact_top_k, html_text, jaccard_join, language_id, line_dedup, lm_score, near_dedup,
    subvector_clusters, substring_dedup, token_alignment,
)
from clickloom.llm.frames import in_fold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    spans = decontaminate.contaminated_spans(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return spans.select(
        F.col("doc").alias("doc_id"), "n_words", decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (decontaminate.n_hit() > 0).alias("contaminated"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op1_decontaminate"] = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents
), i AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, win, len(win) AS size FROM (
        SELECT item_id, unnest(list_transform(range(0, greatest(len(w) - 9, 1)), lambda x: list_slice(w, x + 1, x + 10))) AS win
        FROM i WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT size FROM item_windows
), places AS (
    SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size
), hits AS (
    SELECT p.rid, p.p, p.size, t.item_id FROM places p
    JOIN item_windows t ON t.size = p.size AND t.win = list_slice(p.w, p.p, p.p + p.size - 1)
), words AS (
    SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(range(p, p + size)) AS pos FROM hits) GROUP BY rid
), named AS (
    SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(named.items, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.rid = d.rid LEFT JOIN named ON named.rid = d.rid
"""


@query
def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE["op5_line_dedup"] = """
WITH lines AS (
    SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM lines
), often AS (
    SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.*, coalesce(k.doc_id < o.keeper, false) AS gone FROM keyed k LEFT JOIN often o ON k.line_key = o.line_key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid
"""


@query
def op7_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    control = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat_format.conversation_digests(chat_format.format_conversations(turns.unionByName(planted)))


@query
def op2_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return exact_top_k.exact_top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLE["op2_exact_top_k"] = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""


@query
def op4_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    return best_fit.pack(table(spark, sf, "documents"))


@query
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = in_fold("doc_id", 4, 2)
    model = language_id.train(language_id.training_sample(docs, ~held_out, "text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents")).select(F.col("doc").alias("doc_id"), "class_id")


@query
def op8_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = html_text.extract_text(table(spark, sf, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    scored = lm_score.score_texts(table(spark, sf, "documents"), ~in_fold("doc_id", 10, 0))
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         "score")


@query
def op12_centroid_clusters(spark: SparkSession, sf: str) -> DataFrame:
    found, centroids = subvector_clusters.cluster_vectors(table(spark, sf, "embeddings"))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # one row per cluster, 40 at most: small enough to broadcast at any size of the table
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(F.broadcast(named), "cluster")
    whole = found.agg(F.sum("distance").alias("inertia")).first()["inertia"]
    return found.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256")


def _clusters_sql(k: int, rounds: int) -> str:
    """Lloyd's rounds one after the other; a round's centroids in long form (c, d, x)."""
    nearest = """n{r} AS MATERIALIZED (
    SELECT rid, c, dist FROM (
        SELECT p.rid, m.c, sum((p.x - m.x) * (p.x - m.x)) AS dist,
               row_number() OVER (PARTITION BY p.rid ORDER BY sum((p.x - m.x) * (p.x - m.x)), m.c) AS place
        FROM parts p JOIN m{r} m ON m.d = p.d GROUP BY p.rid, m.c)
    WHERE place = 1
)"""
    moved = """m{n} AS MATERIALIZED (
    SELECT m.c, m.d, coalesce(s.x, m.x) AS x FROM m{r} m LEFT JOIN (
        SELECT n.c, p.d, CAST(sum(p.x) // count(*) - CASE WHEN sum(p.x) % count(*) < 0 THEN 1 ELSE 0 END AS BIGINT) AS x
        FROM n{r} n JOIN parts p ON p.rid = n.rid GROUP BY n.c, p.d) s ON s.c = m.c AND s.d = m.d
)"""
    steps = [nearest.format(r=0)]
    for r in range(rounds):
        steps += [moved.format(r=r, n=r + 1), nearest.format(r=r + 1)]
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v
), m0 AS MATERIALIZED (
    SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM (
        SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM v)
    WHERE c < {k}
), {", ".join(steps)}, digests AS (
    SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS digest FROM m{rounds} GROUP BY c
)
SELECT v.vec_id, CAST(n.c AS INTEGER) AS cluster, CAST(n.dist AS BIGINT) AS distance,
       CAST(sum(n.dist) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia, CAST(sum(n.dist) OVER () AS BIGINT) AS inertia,
       digests.digest AS centroid_sha256
FROM n{rounds} n JOIN v ON v.rid = n.rid JOIN digests ON digests.c = n.c
"""


ORACLE["op12_centroid_clusters"] = _clusters_sql(40, 5)


@query
def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    found = token_alignment.align_tokens(table(spark, sf, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op11_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf, "documents")).select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


ORACLE["op11_jaccard_join"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^ \t-\r]+') AS w FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT rid, unnest(CASE WHEN len(w) < 5 THEN [w]
        ELSE list_transform(range(1, len(w) - 3), lambda x: list_slice(w, x, x + 4)) END) AS s
    FROM d WHERE len(w) > 0
), sizes AS MATERIALIZED (
    SELECT rid, count(*) AS n FROM shingles GROUP BY rid
), keyed AS MATERIALIZED (
    SELECT rid, n, md5(string_agg(md5(array_to_string(s, ' ')), '' ORDER BY md5(array_to_string(s, ' ')))) AS k
    FROM shingles JOIN sizes USING (rid) GROUP BY rid, n
), sets AS MATERIALIZED (
    SELECT n, k, min(rid) AS one FROM keyed GROUP BY n, k
), member AS MATERIALIZED (
    SELECT keyed.rid, sets.one FROM keyed JOIN sets USING (n, k)
), few AS MATERIALIZED (
    SELECT rid, n, hash(s) AS h, s FROM shingles JOIN sizes USING (rid) WHERE rid IN (SELECT one FROM sets)
), links AS MATERIALIZED (
    SELECT a.rid AS a, b.rid AS b FROM few a JOIN few b ON a.h = b.h AND a.s = b.s AND a.rid <> b.rid
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT one AS rid, one AS root FROM sets
    UNION
    SELECT links.b AS rid, reach.root FROM reach JOIN links ON links.a = reach.rid
), roots AS (
    SELECT rid, min(root) AS root FROM reach GROUP BY rid
), component AS (
    SELECT root, min(d.doc_id) AS component_id FROM member m JOIN roots ON roots.rid = m.one JOIN d ON d.rid = m.rid GROUP BY root
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles,
       CASE WHEN m.rid IS NULL THEN d.doc_id ELSE c.component_id END AS component_id
FROM d LEFT JOIN sizes ON sizes.rid = d.rid LEFT JOIN member m ON m.rid = d.rid LEFT JOIN roots ON roots.rid = m.one
LEFT JOIN component c ON c.root = roots.root
"""
