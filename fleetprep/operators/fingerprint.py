"""Fingerprints of tables: equal for equal rows in any order, different if a cell, a row or its number of copies differs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep.functions.text import name


def cell_text(df: DataFrame, column: str) -> Column:
    """A cell with its length in front, so that neighbouring cells cannot run into each other; a missing one is a dash. Dates count as times."""
    c = name(column)
    if isinstance(df.schema[column].dataType, T.DateType):
        c = c.cast("timestamp")
    text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (row_count, hash_sum, hash_xor) over the columns, by name, whatever their order.

    A row's md5 gives two numbers of 60 bits; one is added up in wide decimals, the other combined by exclusive or. Both are
    combined before the shuffle. An empty table gives 0 rows, sum 0 and xor 0.
    """
    columns = sorted(df.columns if columns is None else columns)
    digest = F.md5(F.concat(F.lit(""), *[cell_text(df, c) for c in columns]).cast("binary"))
    number = lambda start: F.conv(F.substring("digest", start, 15), 16, 10)
    rows = df.select(digest.alias("digest")).select(number(1).cast("decimal(38,0)").alias("a"), number(17).cast("bigint").alias("b"))
    return rows.agg(
        F.count("*").alias("row_count"), F.coalesce(F.sum("a"), F.lit(0)).cast("string").alias("hash_sum"), F.coalesce(F.bit_xor("b"), F.lit(0).cast("bigint")).alias("hash_xor")
    )


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often, by their common columns; other columns make them differ."""
    return sorted(a.columns) == sorted(b.columns) and fingerprint(a).first() == fingerprint(b).first()
