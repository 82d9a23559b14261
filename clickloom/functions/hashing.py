"""Hash buckets and the train/test split.

Two hashes: the md5 form gives the same number in any engine, so results can be
checked elsewhere; ``xxhash64`` is about ten times quicker and meant for encoding at scale.
The ``_sql`` functions return SQL text because the training pipeline stores it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PORTABLE = "md5"
FAST = "xxhash64"

#: Buckets above this one (of 100) are the test part.
SPLIT_BUCKETS = 100
LAST_TRAIN_BUCKET = 80

_HASH_RANGE = 1 << 32
#: Makes (a, b) and (b, a) differ; the sum stays below 2^53.
CROSS_FACTOR = 1_000_003


def hash32_sql(text: str, method: str = PORTABLE) -> str:
    """32 bit hash of a text, as a bigint."""
    if method == PORTABLE:
        return f"cast(conv(substring(md5({text}), 1, 8), 16, 10) as bigint)"
    if method == FAST:
        return f"pmod(xxhash64({text}), {_HASH_RANGE}L)"
    raise ValueError(f"unknown hash method {method!r}")


def bucket_sql(hashed: str, size: int) -> str:
    """Bucket 0 .. size-1 of a hash."""
    return f"pmod({hashed}, {size}L)"


def cross_sql(hash_a: str, hash_b: str, size: int) -> str:
    """Bucket of a pair of values from the hashes of both, so no pair text is built or hashed."""
    return f"pmod({hash_a} * {CROSS_FACTOR}L + {hash_b}, {size}L)"


def hash32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def bucket(text: Column, size: int) -> Column:
    return F.pmod(hash32(text), F.lit(size).cast("bigint"))


def split_flag(*parts: Column) -> Column:
    """1 (train) or 0 (test) from the hash of the joined parts; NULL hashes as ``None``."""
    text = F.concat(*[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    return F.when(bucket(text, SPLIT_BUCKETS) > LAST_TRAIN_BUCKET, 0).otherwise(1)
