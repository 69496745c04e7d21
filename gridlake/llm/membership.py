"""A bitmap of hashed keys with a fixed size bound, for filtering scans.

``build`` marks 64-bit keys in a bitmap of at most ``2**MAX_LOG_BITS`` bits
(32 MB), whatever the number of keys, so it may be collected and broadcast.
A key that was added is always found; others pass by chance, more of them
the fuller the map is.  Callers use it only to skip work: what passes is
compared exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LOG_BITS = 28


class Bitmap:
    def __init__(self, words: np.ndarray, log_bits: int):
        self.words, self.log_bits = words, log_bits

    def contains(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - self.log_bits)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def build(keys: DataFrame, column: str, count: int) -> Bitmap:
    """Bitmap of a column of well-mixed 64-bit hashes, about 16 bits a key."""
    log_bits = min(MAX_LOG_BITS, max(16, (16 * count).bit_length()))
    place = F.shiftrightunsigned(F.col(column), 64 - log_bits)
    marked = keys.select(F.shiftright(place, 6).alias("word"), F.expr("1L").alias("one"), place.alias("place")) \
        .select("word", F.expr("shiftleft(one, cast(place & 63 as int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (log_bits - 6), dtype=np.uint64)
    words[marked.column("word").to_numpy()] = marked.column("bits").to_numpy().view(np.uint64)
    return Bitmap(words, log_bits)
