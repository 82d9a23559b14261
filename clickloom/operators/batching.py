"""Training order: shards, shuffled rows, epochs, batches, step cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.hashing import hash32

_HASH_BITS = 32


def part_names(prefix: str, files: int) -> list[str]:
    """``part-00000`` style names of a training folder."""
    return [f"{prefix}/part-{i:05d}" for i in range(files)]


def shard_of(index: Column, shards: int) -> Column:
    """Round robin: file ``index`` belongs to shard ``index % shards``."""
    return F.pmod(index, F.lit(shards)).cast("int")


def shard_report(rows: DataFrame, file_index: Column, shards: int) -> DataFrame:
    """Files and rows of every shard, to see which worker would lag."""
    per_file = rows.groupBy(file_index.alias("file_index")).agg(F.count(F.lit(1)).alias("rows"))
    return (
        per_file.groupBy(shard_of(F.col("file_index"), shards).alias("shard"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.max("rows").alias("largest_file"))
    )


def shuffle_key(key: str, seed: int) -> Column:
    """Random-looking but repeatable sort value of a row."""
    return hash32(F.concat_ws("|", F.lit(seed).cast("string"), F.col(key).cast("string")))


def shuffle_rows(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """All rows in a repeatable random order (``key`` must be unique).

    The whole table is shuffled by range, not just a buffer of neighbours.
    """
    return rows.withColumn("shuffle_key", shuffle_key(key, seed)).orderBy("shuffle_key", key)


def repeat_epochs(rows: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch, numbered from 0; no join and no shuffle."""
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def add_batches(
    rows: DataFrame,
    key: str,
    batch_size: int,
    seed: int,
    shard: str | None = None,
    slice_bits: int = 12,
    epoch: str | None = None,
) -> DataFrame:
    """Number the shuffled rows of each shard (and epoch) and cut them into batches.

    Adds ``position`` (from 0), ``batch`` and ``shuffle_key``. The exact row number
    is found in two parts, so no task sorts a whole shard: rows are cut by the
    leading bits of their sort value into ``2 ** slice_bits`` slices; each slice is
    numbered on its own and starts where the slices before it end. The second
    window sees slice counts only, ``2 ** slice_bits`` rows per shard. ``key`` must
    be unique, which keeps the slices even however large the shard.
    """
    by = [c for c in (shard, epoch) if c]
    cut = 1 << (_HASH_BITS - slice_bits)
    sort_key = shuffle_key(key, seed) if epoch is None else hash32(
        F.concat_ws("|", F.lit(seed).cast("string"), F.col(epoch).cast("string"), F.col(key).cast("string"))
    )
    keyed = rows.withColumn("shuffle_key", sort_key).withColumn(
        "_slice", F.floor(F.col("shuffle_key") / F.lit(cut)).cast("int")
    )
    before = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    starts = (
        keyed.groupBy(*by, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *by,
            "_slice",
            F.coalesce(
                F.sum("_n").over(before.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_start"),
        )
    )
    within = Window.partitionBy(*by, "_slice").orderBy("shuffle_key", key)
    numbered = keyed.withColumn("_row", F.row_number().over(within))
    position = (F.col("_start") + F.col("_row") - 1).cast("bigint")
    return (
        numbered.join(starts, [*by, "_slice"])
        .withColumn("position", position)
        .withColumn("batch", F.floor(F.col("position") / F.lit(batch_size)).cast("bigint"))
        .drop("_slice", "_row", "_start")
    )


def cap_steps(rows: DataFrame, max_steps: int | None, step: str = "batch") -> DataFrame:
    """Batches a training run with a step cap would read; ``None`` reads all."""
    return rows if max_steps is None else rows.where(F.col(step) < max_steps)
