"""Fixed-size bitmaps of hashes, sent to tasks to hold back rows before a join.

A bitmap lets through every key it was built from and some others, so an exact join follows. Its size
is a parameter, never that of the data; with too many keys it lets more through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26


def bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """One bit for the top bits of each 64-bit key; 2 ** (bits - 6) numbers at most come to the driver."""
    slot = F.shiftrightunsigned(column, 64 - bits)
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit")
    cell = keys.select(slot.alias("slot")).select(F.shiftright("slot", 6).alias("cell"), bit)
    found = cell.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()
    held = np.zeros(1 << max(bits - 6, 0), np.int64)
    held[found.cell.to_numpy(np.int64)] = found.bits.to_numpy(np.int64)
    return held.view(np.uint8)


def passes(held: np.ndarray, keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Which keys may be among those of the bitmap."""
    slot = keys.view(np.uint64) >> np.uint64(64 - bits)
    return (held[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
