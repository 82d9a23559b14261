"""Row checks: what a step can use and what it rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import usable_id


def impression_problem() -> Column:
    """Why an impression yields no positions; NULL when it is fine."""
    props = F.col("props")
    return (
        F.when(~F.coalesce(usable_id("device"), F.lit(False)), "no device")
        .when(F.col("content").isNull(), "no content")
        .when(props.isNull(), "no props")
        .when(F.from_json(props, "map<string,string>").isNull(), "bad props")
    )


def count_checked(checked: DataFrame) -> dict[str | None, int]:
    """Impressions by problem (None: fine) of a table that has some of them several times, told apart by ``row_id``.

    Rows without a ``row_id`` count one by one. Both columns are narrow; problems are few.
    """
    alone, named = F.col("row_id").isNull(), F.col("row_id").isNotNull()
    once = checked.where(named).select("row_id", "problem").distinct().groupBy("problem").agg(F.count(F.lit(1)).alias("n"))
    found = checked.where(alone).groupBy("problem").agg(F.count(F.lit(1)).alias("n")).unionByName(once)
    return {r["problem"]: r["n"] for r in found.groupBy("problem").agg(F.sum("n").alias("n")).collect()}


def split_rejects(rows: DataFrame, problem: Column) -> tuple[DataFrame, DataFrame]:
    """The usable rows, and the others with their ``problem``."""
    checked = rows.withColumn("problem", problem)
    return checked.where(F.col("problem").isNull()).drop("problem"), checked.where(F.col("problem").isNotNull())


def count_rejects(rows: DataFrame, problem: Column, *by: str) -> DataFrame:
    """Good and rejected rows per group, in one pass."""
    return (
        rows.select(*by, problem.alias("problem"))
        .groupBy(*by)
        .agg(
            F.count_if(F.col("problem").isNull()).alias("good"),
            F.count_if(F.col("problem").isNotNull()).alias("rejected"),
        )
    )
