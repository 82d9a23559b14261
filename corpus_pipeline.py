"""Documents to packed training rows: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Edge cases are those of the operators: null and letterless
texts go in the first stage, which fills in missing languages and keeps all other texts where no document is labelled, repeated documents in the third, documents that hold a benchmark passage in the fourth; an
empty table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import best_fit, decontaminate, language_id, line_dedup, near_dedup
from clickloom.llm.frames import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter in their text go: no language can be told. What is labelled trains the model.

    Documents without a label get the language found. Where nothing is labelled no language can be learnt: then
    texts with a letter stay, without a label.
    """
    model = language_id.train(language_id.training_sample(docs, F.lit(True), "text", "lang"))
    if not model.languages:
        return docs.filter(F.col("text").cast("string").rlike(r"\p{L}"))
    found = language_id.identify(docs, model)
    predicted = F.col(found.columns[-2])
    known = found.filter(predicted != language_id.UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", predicted)).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the last one alone; n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each class of near duplicates stays."""
    return near_dedup.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their bins and offsets."""
    return best_fit.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_class),
    ("decontaminate", without_benchmark),
    ("best_fit", packed),
]

#: Signatures, trained models and packing are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
