"""Language identification by code length: one byte context trie per language, frozen after training.

The tries learn from a bounded sample of labelled documents per language (``SAMPLE_DOCS`` different texts of at most
``SAMPLE_CHARS`` characters each, the first by hash; beginnings of longer ones where these are too few), so the model
that is broadcast is bounded whatever the table's size.
Every document is scored whole under every trie; the language with the shortest code is predicted, and
its score is its share of the probability of the text over all languages, all equally likely beforehand.

The model is trained on text and language alone; a prediction reads the text alone. Edge cases: a text that is null or
has no letter is ``und`` with score 0, and so is every text where nothing could be learnt; null
languages and texts are not learnt from; equal scores go to the smaller language name; repeated rows are
learnt from once and scored alike; an empty table has no rows; all columns pass through, added names get underscores where taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.bytework import slices, text_buffer
from clickloom.llm.frames import fresh, stage
from clickloom.llm.ppm import ContextTrie, counted, levels_of, text_grams

ORDER = 3
SAMPLE_DOCS = 256
SAMPLE_CHARS = 32_768
UNKNOWN = "und"
#: Grams whose code lengths a task remembers before it starts anew.
KNOWN_GRAMS = 1 << 20
#: Bytes of text scored at once.
SCORE_BYTES = 4 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    tries: list[ContextTrie]
    order: int


def training_sample(docs: DataFrame, usable: Column, text: str, lang: str, docs_per_language: int = SAMPLE_DOCS,
                    most_chars: int = SAMPLE_CHARS) -> DataFrame:
    """(lang, text): for each language the different texts of least hash among the usable ones.

    Copies count once. Only where whole texts are too few, beginnings of longer ones fill the places left.
    """
    rows = docs.filter(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.substring(F.col(text).cast("string"), 1, most_chars).alias("text"),
        (F.length(text) > most_chars).alias("cut")).withColumn("key", F.xxhash64("text"))
    keys = stage(rows.groupBy("lang", "key").agg(F.min("cut").alias("cut")), "language-keys")
    # staged, its size is known, so that Spark sends it to the keys and not the keys to it
    counts = stage(keys.groupBy("lang").agg(F.count_if(~F.col("cut")).alias("n_whole"), F.count_if("cut").alias("n_cut")),
                   "language-counts")
    # the share that leaves about twice the texts wanted, so that only those are sorted
    place, most = F.col("key") / F.lit(2.0 ** 64) + 0.5, 2 * docs_per_language + 50
    near = keys.join(counts, "lang").filter(
        F.when(F.col("cut"), (F.col("n_whole") < docs_per_language) & (place * F.col("n_cut") <= most))
        .otherwise(place * F.col("n_whole") <= most))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("cut", "key"))
    chosen = near.withColumn("rank", rank).filter(F.col("rank") <= docs_per_language).select("lang", "key")
    # likewise sent to the texts; their copies are folded before they are shuffled
    found = rows.join(stage(chosen, "language-sample"), ["lang", "key"])
    return found.groupBy("lang", "key").agg(F.min("text").alias("text")).select("lang", "text")


def train(sample: DataFrame, order: int = ORDER) -> LanguageModel:
    """Counts grams per language where the sample lies, then gathers the counts, which the sample bounds."""
    def work(table: pa.Table) -> pa.Table:
        grams, counts = counted(text_grams(table.column("text").combine_chunks(), order)[0])
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(grams), pa.string()), "gram": grams,
                         "n": counts})

    found = sample.groupBy("lang").applyInArrow(work, "lang string, gram long, n long").toPandas()
    languages = sorted(found["lang"].unique())
    tries = []
    for name in languages:
        own = found[found["lang"] == name]
        tries.append(ContextTrie(levels_of(own["gram"].to_numpy(np.int64), own["n"].to_numpy(np.int64), order)))
    return LanguageModel(languages, tries, order)


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each row has a letter; only rows without ASCII letters are looked at one by one."""
    data, at = text_buffer(column)
    low = data | 32
    plain = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
    out = plain[at[1:]] > plain[at[:-1]]
    for r in np.flatnonzero(~out):
        out[r] = any(c.isalpha() for c in data[at[r]:at[r + 1]].tobytes().decode())
    return out


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """All rows and columns, with the predicted language and its score added."""
    lang_pred, score = fresh(docs.columns, lang_pred), fresh(docs.columns, score)
    shared = docs.sparkSession.sparkContext.broadcast([trie.levels for trie in model.tries])  # plain arrays
    languages, order = model.languages, model.order
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [ContextTrie(levels) for levels in shared.value]
        known = np.zeros(0, dtype=np.int64)  # grams met so far, and their code lengths by language
        lengths = np.zeros((len(tries), 0))
        for part in slices(batches, text, SCORE_BYTES):
            column = part.column(text)
            names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            if tries:
                grams, first = text_grams(column, order)
                codes, keys = pd.factorize(grams)
                del grams
                if len(known) > KNOWN_GRAMS:
                    known, lengths = known[:0], lengths[:, :0]
                new = np.setdiff1d(keys, known, assume_unique=True)
                if len(new):
                    more = np.stack([t.log2_prob(new) for t in tries])
                    known, lengths = np.concatenate([known, new]), np.concatenate([lengths, more], axis=1)
                    by = np.argsort(known)
                    known, lengths = known[by], lengths[:, by]
                at = np.searchsorted(known, keys)
                total = np.stack([np.add.reduceat(row[at][codes], first) for row in lengths])
                best = total.argmax(axis=0)
                shares = 1 / np.exp2(np.maximum(total - total.max(axis=0), -1000)).sum(axis=0)
                read = has_letter(column) & column.is_valid().to_numpy(zero_copy_only=False)
                names = [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), read.tolist(), strict=True)]
                scores = np.where(read, shares, 0.0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*part.schema.names, lang_pred, score])

    return docs.mapInArrow(work, schema)
