"""A bitmap of fixed size that says which hashes may be in a set.

It spares rows that cannot find a partner a shuffle. It never drops a row that could:
on very large inputs it fills up and only saves less.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25  # 4 MB, whatever the input
MASK = BITS - 1


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a column of 64-bit hashes, built by tasks and joined here."""
    place = F.col(column).bitwiseAND(F.lit(MASK)) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for part, bits in parts.collect():
        block = np.frombuffer(bits, dtype=np.uint8)
        at = (part - 1) * len(block)
        out[at : at + len(block)] = block
    return out


def may_have(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each 64-bit hash: may it be in the set?"""
    place = hashes.astype(np.int64) & MASK
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def id_hash(column: Column) -> Column:
    return F.xxhash64(column)
