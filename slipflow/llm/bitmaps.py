"""Bit maps of hashes: a bounded stand-in for a set that is too large to send to the tasks.

A bit map says yes for every hash that was put in and seldom for another, so it may only decide what
is looked at more closely. Its size follows the number of hashes up to ``MOST_BITS`` (32 MB), whatever
the data; more hashes make it less sharp, not larger.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28
BLOCK_BYTES = 4096  # of a block of Spark's bitmap aggregates


class Bits:
    def __init__(self, bits: int, blocks: dict[int, bytes]):
        self.mask = np.uint64(bits - 1)
        self.bytes = np.zeros(max(bits // 8, BLOCK_BYTES), np.uint8)
        for k, block in blocks.items():
            self.bytes[k * BLOCK_BYTES:(k + 1) * BLOCK_BYTES] = np.frombuffer(block, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash (uint64) may have been put in."""
        at = hashes & self.mask
        return (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_map(rows: DataFrame, n: int, most: int = MOST_BITS) -> Bits:
    """Bit map of the column ``hash`` (long) of ``n`` rows: 64 bits for each, ``most`` in all at most."""
    bits = 8 * BLOCK_BYTES
    while bits < min(64 * n, most):
        bits *= 2
    at = F.col("hash").bitwiseAND(F.lit(bits - 1).cast("long")) + 1
    blocks = (rows.select(F.bitmap_bucket_number(at).alias("block"), F.bitmap_bit_position(at).alias("bit"))
              .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))
    return Bits(bits, {r["block"] - 1: bytes(r["bits"]) for r in blocks.toLocalIterator()})
