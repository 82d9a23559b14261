"""Constant rows for throughput trials."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shaped(value: Any, shape: tuple[int, ...], dtype: str | None = None) -> Column:
    """A constant of the given shape: a scalar for ``()``, else nested arrays."""
    column = F.lit(value) if dtype is None else F.lit(value).cast(dtype)
    for size in reversed(shape):
        column = F.array_repeat(column, size)
    return column


def with_constants(
    rows: DataFrame,
    inputs: dict[str, tuple[int, ...]],
    input_value: Any = 0,
    input_dtype: str | None = None,
    label_shape: tuple[int, ...] | None = None,
    label_value: Any = 0,
    label_dtype: str | None = None,
) -> DataFrame:
    """Add constant input columns, and a constant label when it has a shape."""
    columns = {name: shaped(input_value, shape, input_dtype) for name, shape in inputs.items()}
    if label_shape is not None:
        columns["label"] = shaped(label_value, label_shape, label_dtype)
    return rows.withColumns(columns)


def constant_rows(spark: SparkSession, n: int, inputs: dict[str, tuple[int, ...]], **values: Any) -> DataFrame:
    """``n`` constant rows; where a training loop would repeat forever, ``n`` bounds it."""
    return with_constants(spark.range(n).withColumnRenamed("id", "row_id"), inputs, **values)
