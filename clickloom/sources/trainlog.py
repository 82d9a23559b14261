"""Progress and evaluation lines of a training log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMBER = r"([-+0-9.eE]+)"
PROGRESS = rf"loss = {_NUMBER}, step = ([0-9]+) \({_NUMBER} sec\)"
EVALUATION = r"Saving dict for global step ([0-9]+): (.*)$"
PAIR = rf"([A-Za-z_/]+) = {_NUMBER}"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def progress(lines: DataFrame, line: str = "value") -> DataFrame:
    """``loss``, ``step``, ``seconds`` of every progress line; other lines are left out."""
    rest = [c for c in lines.columns if c != line]
    text = F.col(line)
    return lines.where(text.rlike(PROGRESS)).select(
        *rest,
        F.regexp_extract(text, PROGRESS, 1).try_cast("double").alias("loss"),
        F.regexp_extract(text, PROGRESS, 2).try_cast("bigint").alias("step"),
        F.regexp_extract(text, PROGRESS, 3).try_cast("double").alias("seconds"),
    )


def evaluations(lines: DataFrame, line: str = "value") -> DataFrame:
    """One row per metric of every evaluation line, the step metric itself left out."""
    rest = [c for c in lines.columns if c != line]
    text = F.col(line)
    body = F.regexp_extract(text, EVALUATION, 2)
    pairs = F.arrays_zip(
        F.regexp_extract_all(body, F.lit(PAIR), 1).alias("name"),
        F.regexp_extract_all(body, F.lit(PAIR), 2).alias("value"),
    )
    return (
        lines.where(text.rlike(EVALUATION))
        .select(*rest, F.regexp_extract(text, EVALUATION, 1).try_cast("bigint").alias("global_step"),
                F.explode(pairs).alias("_pair"))
        .select(*rest, "global_step", F.col("_pair.name").alias("name"),
                F.col("_pair.value").try_cast("double").alias("value"))
        .where(F.col("name") != "global_step")
    )
