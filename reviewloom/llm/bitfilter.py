"""A set of hashes as bits of bounded size: answers ``perhaps`` or ``surely not``."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the largest filter (32 MB). A larger set only lets more strangers through.
MAX_BITS = 1 << 28
_BITS_PER_HASH = 32
_SPOT = 30
_CHUNK = 4096


def spread_bits(x: np.ndarray) -> np.ndarray:
    """64-bit numbers whose every bit depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build(hashes: DataFrame, name: str, max_bits: int = MAX_BITS) -> Broadcast:
    """The filter of the evenly spread 64-bit hashes in column ``name``; the executors set the bits.

    Each hash sets two bits. The driver only puts together the pieces, ``max_bits`` at most.
    """
    size = 1 << max(16, min(max_bits, _BITS_PER_HASH * max(1, hashes.count())).bit_length() - 1)
    h: Column = F.col(name)
    spots = F.array(h.bitwiseAND(F.lit(size - 1)),
                    F.shiftrightunsigned(h, 64 - _SPOT).bitwiseAND(F.lit(size - 1)))
    place = F.col("spot") + 1  # the bitmap functions count from 1
    pieces = hashes.select(F.explode(spots).alias("spot")).groupBy(
        F.bitmap_bucket_number(place).alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    whole = np.zeros(size // 8, np.uint8)
    for at, bits in pieces.toLocalIterator():
        start = (at - 1) * _CHUNK
        whole[start:start + _CHUNK] = np.frombuffer(bits, np.uint8)[:whole.size - start]
    return hashes.sparkSession.sparkContext.broadcast(whole)


def may_contain(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) the filter may hold; those it holds are always among them."""
    mask = np.uint64(bits.size * 8 - 1)
    found = np.ones(hashes.size, bool)
    for spot in (hashes & mask, (hashes >> np.uint64(64 - _SPOT)) & mask):
        found &= (bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found
