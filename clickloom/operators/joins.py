"""Equi joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.text import any_null

#: Rows of one key that a single task may hold; a key with more is split.
ROWS_PER_TASK = 2_000_000
#: NULL keys match nothing, so they can be spread over every task without replicas.
NULL_SPREAD = 1 << 20

_SALT = "_salt"
_PIECES = "_pieces"


def hot_keys(
    rows: DataFrame, keys: str | Sequence[str], rows_per_task: int = ROWS_PER_TASK, weight: str | None = None
) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and into how many pieces to cut each.

    A row counts as many rows as its ``weight`` says (the copies it stands for, the positions it lists).
    Counts are partly summed before the shuffle. There are no more such keys than
    ``rows_per_task`` goes into the rows; Spark broadcasts them if their size allows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    amount = F.sum(F.col(weight).cast("bigint")) if weight else F.count(F.lit(1))
    counts = rows.where(~any_null(*keys)).groupBy(*keys).agg(amount.alias("_n"))
    return counts.where(F.col("_n") > rows_per_task).select(
        *keys, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias(_PIECES)
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` (inner or left) with hot keys of ``left`` cut in pieces.

    ``hot`` comes from :func:`hot_keys` over the same keys (or some of them). A
    hot key's left rows go to one of its pieces by a hash of ``salt_by`` (all
    hashable left columns when not given; a row id among them parts exact copies
    too) and its right rows are repeated once per piece, so the result is the
    plain join's. Rows with a NULL key are spread as well. The salt depends on
    row content only: a lost task recomputes the same one. Small right sides are
    still broadcast by Spark, from its own size check.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join does inner and left joins, not {how!r}")
    on = [on] if isinstance(on, str) else list(on)
    if hot is None and how == "inner":
        return left.join(right, on, "inner")

    spread = f"xxhash64({_listed(salt_by or _hashable(left))})"
    null_key = " or ".join(f"`{c}` is null" for c in on)
    if hot is None:
        salt = f"if({null_key}, pmod({spread}, {NULL_SPREAD}), 0)"
        salted, repeated = left, right.withColumn(_SALT, F.lit(0))
    else:
        # coalesced, as a salt that might be NULL would make Spark filter on it and hash every row twice
        salt = f"pmod({spread}, if({null_key}, {NULL_SPREAD}, coalesce({_PIECES}, 1)))"
        hot_on = [c for c in hot.columns if c != _PIECES]
        salted = left.join(hot, hot_on, "left")
        repeated = right.join(hot, hot_on, "left").selectExpr(
            *_quoted(right.columns), f"explode(sequence(0, coalesce({_PIECES}, 1) - 1)) as {_SALT}"
        )
    salted = salted.selectExpr(*_quoted(left.columns), f"coalesce(cast({salt} as int), 0) as {_SALT}")
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def _quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def _listed(columns: Sequence[str]) -> str:
    return ", ".join(_quoted(columns))


def _hashable(rows: DataFrame) -> list[str]:
    return [f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]


def count_copies(rows: DataFrame, keys: Sequence[str], copies: str, weight: str | None = None) -> DataFrame:
    """Collapse equal rows to one with a ``copies`` column (summed before the shuffle).

    Joins then move and match one row where the input had many; see
    :func:`expand_copies` for the way back.
    """
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    return rows.groupBy(*keys).agg(amount.alias(copies))


_STEP = 4096
#: Copies of one row that stay together when copies are spread.
COPIES_TOGETHER = 1 << 16

_PART = "_part"


def split_copies(rows: DataFrame, copies: str, most: int = COPIES_TOGETHER) -> DataFrame:
    """Rows that stand for more than ``most`` copies as several that stand for ``most`` at most, numbered in ``_part``.

    The number tells them apart, so a salt or a shuffle can part them.
    """
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(`{copies}` - 1) div {most}")))
    amount = F.least(F.lit(most).cast("bigint"), F.col(copies) - F.col(_PART) * most)
    return rows.withColumn(_PART, parts).withColumn(copies, amount)


def expand_copies(rows: DataFrame, copies: str, tasks: int | None = None, most: int = COPIES_TOGETHER) -> DataFrame:
    """Write every row out ``copies`` times.

    Two generators, so that no array grows with the number of copies beyond
    ``copies / 4096`` entries. With ``tasks`` the rows are split first (:func:`split_copies`) and the parts shuffled over so
    many tasks, so the copies of one row are written by many; what is shuffled is one row per ``most`` copies.
    """
    if tasks:
        rows = split_copies(rows, copies, most)
        rows = rows.repartition(tasks, F.xxhash64(*_quoted(_hashable(rows)))).drop(_PART)
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({copies} - 1) div {_STEP}")))
    rest = F.explode(
        F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(_STEP), F.col(copies) - F.col("_block") * _STEP))
    )
    return rows.withColumn("_block", blocks).withColumn("_copy", rest).drop("_block", "_copy", copies)
