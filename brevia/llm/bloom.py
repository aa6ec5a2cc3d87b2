"""A Bloom filter of fixed size that thins rows before an exact join.

It has ``BITS`` bits whatever the table's size, so it may be broadcast; when it is full it
lets everything pass, and the join that follows decides in any case.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def bloom(hashes: DataFrame, hashed: Column) -> np.ndarray:
    """The filter of a column of well mixed 64-bit values."""
    bit = hashed.bitwiseAND(BITS - 1)
    words = hashes.select(bit.alias("b")).select(
        F.shiftright("b", 6).alias("w"), F.expr("shiftleft(1L, cast(b & 63 AS int))").alias("m")
    )
    found = words.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[found.column("w").to_numpy()] = found.column("m").to_numpy()
    return out.view(np.uint64)


def passes(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    b = hashed.view(np.uint64) & np.uint64(BITS - 1)
    return (bits[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1) > 0
