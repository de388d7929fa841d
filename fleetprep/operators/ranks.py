"""Exact positions in a total order, found by counting instead of sorting the table.

A position of interest (the 20 % row of a hash order, the end of a fold) is narrowed down by histograms over the leading bits of a
whole-number order column, 14 bits a pass. Rows are only counted; counts, positions and ranges stay tables, so there may be any
number of strata, and the driver sees two numbers a pass. What comes out is the row at each position, so that a split becomes a
comparison and no row has to move. 10^12 rows with spread-out numbers need two histograms and one look at the few thousand rows that are left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetprep.cluster import stage

STEP_BITS = 14  # 16 384 counts per range and pass
LEAF_ROWS = 16_384  # rows that may be put in order to read off a position
SIGN = -(2**63)


def bounds(df: DataFrame, order: Column) -> tuple[int, int] | None:
    """Smallest and largest order number, None without rows."""
    row = df.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    return None if row.lo is None else (row.lo, row.hi)


def stratum_key(stratum: Column | None) -> Column:
    """Text that names a stratum; missing values are a stratum of their own, before all others."""
    return F.lit("") if stratum is None else F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit(""))


def _leading(shift: int) -> Column:
    """The order number without its last bits, the sign turned so that it sorts like the number."""
    return F.shiftrightunsigned(F.col("x").bitwiseXOR(F.lit(SIGN)), shift) if shift else F.col("x").bitwiseXOR(F.lit(SIGN))


def marks_at(
    df: DataFrame,
    order: Column,
    tie: Column,
    lo: int,
    hi: int,
    positions: Callable[[DataFrame], DataFrame],
    stratum: Column | None = None,
) -> DataFrame:
    """(s, p, x, t, upto): the row at position p of each stratum s, and how many rows come no later than it.

    order is a whole-number column between lo and hi, without missing values; ties are ordered by tie. positions gets the
    rows per stratum (s, n), which the first histogram has counted along the way, and names the wanted positions (s, p), 1 for the first row.
    upto exceeds p where copies of one key share the place. Positions outside 1..n are an error.
    """
    rows = df.select(stratum_key(stratum).alias("s"), order.cast("bigint").alias("x"), tie.alias("t"))
    shift = max((lo ^ hi).bit_length() - STEP_BITS, 0) if (lo < 0) == (hi < 0) else 64 - STEP_BITS
    counts = stage(rows.groupBy("s", _leading(shift).alias("b")).agg(F.count("*").alias("n")))
    sizes = counts.groupBy("s").agg(F.sum("n").alias("n"))
    wanted = stage(positions(sizes).select("s", F.col("p").cast("bigint").alias("p")).distinct())
    wrong = wanted.join(sizes, "s", "left").where("p < 1 OR n IS NULL OR p > n").first()
    if wrong:
        raise ValueError(f"position {wrong.p} is outside 1..{wrong.n or 0}")

    leaves = stage(_holding(counts, wanted.withColumn("before", F.lit(0).cast("bigint")), ["s"]))
    while shift and (leaves.agg(F.max("n")).first()[0] or 0) > LEAF_ROWS:
        finer = max(shift - STEP_BITS, 0)
        inside = rows.withColumn("leaf", _leading(shift)).join(leaves.select("s", F.col("b").alias("leaf")).distinct(), ["s", "leaf"], "left_semi")
        counts = inside.groupBy("s", "leaf", _leading(finer).alias("b")).agg(F.count("*").alias("n"))
        leaves = stage(_holding(counts, leaves.select("s", F.col("b").alias("leaf"), "p", "before"), ["s", "leaf"]).drop("leaf"))
        shift = finer
    inside = rows.withColumn("leaf", _leading(shift)).join(leaves.select("s", F.col("b").alias("leaf")).distinct(), ["s", "leaf"], "left_semi")
    counts = inside.groupBy("s", "leaf", F.struct("x", "t").alias("b")).agg(F.count("*").alias("n"))
    found = _holding(counts, leaves.select("s", F.col("b").alias("leaf"), "p", "before"), ["s", "leaf"])
    return stage(found.select("s", "p", F.col("b.x").alias("x"), F.col("b.t").alias("t"), (F.col("before") + F.col("n")).alias("upto")))


def _holding(counts: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """wanted (by..., p, before) with the b of counts (by..., b, n) that holds p; before becomes the rows ahead of that b."""
    upto = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("last", F.sum("n").over(upto))
    both = counts.join(wanted, by).withColumn("last", F.col("last") + F.col("before"))
    return both.where("p > last - n AND p <= last").withColumn("before", F.col("last") - F.col("n")).drop("last")
