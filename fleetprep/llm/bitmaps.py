"""Fixed-size bitmaps of 64-bit keys: they let too many through, never too few, and have the same size whatever the data."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24  # 2 MB


def bitmap(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """A bitmap of a column of longs, put together by the executors; at most 2^bits / 64 words reach the driver."""
    at = F.expr(f"shiftrightunsigned({key}, {64 - bits})")
    words = keys.where(F.col(key).isNotNull()).select(F.shiftright(at, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned({key}, {64 - bits}) & 63 AS INT))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return out


def within(words: np.ndarray, keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Which keys (uint64) may be in the bitmap."""
    at = keys >> np.uint64(64 - bits)
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
