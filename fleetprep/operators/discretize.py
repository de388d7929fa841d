"""Binning a numeric target: equal width, quantiles, explicit bounds, labelled classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetprep.cluster import one_row
from fleetprep.functions.text import name
from fleetprep.functions.values import percent, right_closed_bin, right_closed_class
from fleetprep.operators.quantiles import scalars

INF = float("inf")


def uniform_edges(df: DataFrame, column: str, k: int) -> list[float]:
    """k+1 edges of equal-width bins; the first is lowered by 0.1 % of the range so that the smallest value is inside."""
    row = one_row(df, {"lo": F.min(name(column)).cast("double"), "hi": F.max(name(column)).cast("double")})
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        raise ValueError(f"no values in {column}")
    if lo == hi:
        pad = 0.001 * abs(lo) if lo else 0.001
        lo, hi = lo - pad, hi + pad
        return [lo + (hi - lo) * i / k for i in range(k + 1)]
    edges = [lo + (hi - lo) * i / k for i in range(k)] + [hi]
    edges[0] = lo - 0.001 * (hi - lo)
    return edges


def quantile_edges(df: DataFrame, column: str, ks: Sequence[int]) -> dict[int, list[float]]:
    """Distinct edges of k equally filled bins, for several k with one set of quantiles."""
    steps = sorted({i / k for k in ks for i in range(k + 1)})
    found = dict(zip(steps, scalars(df, {column: name(column)}, steps)[column]))
    return {k: sorted({found[i / k] for i in range(k + 1)}) for k in ks}


def with_bin(df: DataFrame, column: str, edges: Sequence[float], bin_name: str = "bin") -> DataFrame:
    return df.withColumn(bin_name, right_closed_bin(name(column), edges))


def bin_counts(df: DataFrame, column: str, strategies: Mapping[str, Sequence[float]]) -> DataFrame:
    """(strategy, bin, lo, hi, n, pct): rows per right-closed bin of every strategy, empty bins kept.

    All bins of all strategies are counted in one pass; no row is copied.
    """
    aggregates, structs = [], []
    for i, (label, edges) in enumerate(strategies.items()):
        b = right_closed_bin(name(column), edges)
        for j, (lo, hi) in enumerate(zip(edges, edges[1:]), start=1):
            aggregates.append(F.count_if(b == j).alias(f"n{i}_{j}"))
            structs.append(F.struct(
                F.lit(label).alias("strategy"), F.lit(j).alias("bin"), F.lit(float(lo)).alias("lo"),
                F.lit(float(hi)).alias("hi"), F.col(f"n{i}_{j}").alias("n"),
            ))
    counted = df.agg(F.count(name(column)).alias("total"), *aggregates)
    return counted.select("total", F.inline(F.array(*structs))).select(
        "strategy", "bin", "lo", "hi", "n", percent(F.col("n"), F.col("total")).alias("pct")
    )


def bin_spread(counts: DataFrame) -> DataFrame:
    """(strategy, bins, min_pct, max_pct, spread) of bin_counts."""
    return counts.groupBy("strategy").agg(
        F.count("*").alias("bins"), F.min("pct").alias("min_pct"), F.max("pct").alias("max_pct"),
        (F.max("pct") - F.min("pct")).alias("spread"),
    )


def open_edges(bounds: Sequence[float]) -> list[float]:
    return [-INF, *bounds, INF]


def emission_class(df: DataFrame, column: str, bounds: Sequence[float], labels: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, right_closed_class(name(column), bounds, labels))


def class_distribution(
    df: DataFrame, column: str, bounds: Sequence[float], labels: Sequence[str],
    intervals: Mapping[str, str], descriptions: Mapping[str, str],
) -> DataFrame:
    """(class, interval, description, n, pct) for every class, also the empty ones."""
    label = right_closed_class(name(column), bounds, labels)
    counted = df.agg(F.count(name(column)).alias("total"), *[F.count_if(label == c).alias(f"n{i}") for i, c in enumerate(labels)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("class"), F.lit(intervals[c]).alias("interval"),
                 F.lit(descriptions[c]).alias("description"), F.col(f"n{i}").alias("n"))
        for i, c in enumerate(labels)
    ])
    return counted.select("total", F.inline(rows)).select(
        "class", "interval", "description", "n", percent(F.col("n"), F.col("total")).alias("pct")
    )


def require_all_classes(distribution: DataFrame) -> None:
    empty = [r["class"] for r in distribution.where("n = 0").collect()]
    if empty:
        raise ValueError("classes without rows: " + ", ".join(empty))
