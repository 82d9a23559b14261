"""DataFrame helpers of this package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.sources.scratch import drop_staged, stage

__all__ = ["drop_staged", "fresh", "stage", "text_or_empty", "in_fold"]


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name that clashes with none of the taken ones, in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def in_fold(column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into one fold of several; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == fold
