"""A bitmap of fixed size over 64 bit hashes: built by Spark, small enough to broadcast at any size of the data.

It only thins what is shuffled: it lets through all that it was built from, and some more the fuller it is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytework import U64

#: 2^27 bits are 16 MB.
FILTER_BITS = 27
_BUCKET = 32768


def bitmap_of(rows: DataFrame, hashes: Column) -> np.ndarray:
    """Bitmaps of 4 KB by bucket, of the low bits of the hashes; 4,097 such rows come to the driver at most."""
    low = F.pmod(hashes, F.lit(1 << FILTER_BITS))
    found = rows.select(F.bitmap_bucket_number(low).alias("b"), F.bitmap_bit_position(low).alias("p")).groupBy("b").agg(
        F.bitmap_construct_agg("p").alias("bits")).collect()
    bits = np.zeros(((1 << FILTER_BITS) // _BUCKET + 1, _BUCKET // 8), dtype=np.uint8)
    for r in found:
        bits[r["b"]] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return bits


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in it. Bucket 0 holds 0 alone, bucket b the 32,768 values up to 32,768 b."""
    low = (hashes & U64((1 << FILTER_BITS) - 1)).astype(np.int64)
    bucket = (low + _BUCKET - 1) // _BUCKET
    bit = np.where(low == 0, 0, (low - 1) % _BUCKET)
    return (bitmap[bucket, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
