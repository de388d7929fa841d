"""Portable pseudo-random order of rows by their key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_MIN, HASH_MAX = 0, 16**15 - 1


def hash_text(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")).cast("binary"))


def hash_number(key: Column, seed: int | str) -> Column:
    """Leading 60 bits of the hash as a whole number, in the same order as the hash text."""
    return F.conv(F.substring(hash_text(key, seed), 1, 15), 16, 10).cast("bigint")
