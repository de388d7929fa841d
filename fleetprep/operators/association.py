"""Dependence between columns: functional dependency, correlation, correlation ratio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetprep.functions.text import name
from fleetprep.functions.values import percent
from fleetprep.operators.shape import as_text, missing_count, wide_to_long


def column_dependency(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(source, target, source_values, mean_targets, median_targets, max_targets, one_target_pct) per column pair.

    All pairs share one shuffle of distinct (pair, source value, target value), combined before it moves. The median is
    taken over small whole numbers: k different counts need at least k(k+1)/2 rows, so its memory stays small.
    """
    columns = sorted({c for p in pairs for c in p})
    flat = df.select(*[as_text(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    at = {c: f"v{i}" for i, c in enumerate(columns)}
    structs = F.array(*[
        F.struct(F.lit(s).alias("source"), F.lit(t).alias("target"), F.col(at[s]).alias("s"), F.col(at[t]).alias("t"))
        for s, t in pairs
    ])
    distinct = flat.select(F.inline(structs)).where("s is not null and t is not null").distinct()
    per_source = distinct.groupBy("source", "target", "s").agg(F.count("*").alias("k"))
    return per_source.groupBy("source", "target").agg(
        F.count("*").alias("source_values"),
        F.round(F.avg("k"), 3).alias("mean_targets"),
        F.median("k").alias("median_targets"),
        F.max("k").alias("max_targets"),
        F.round(percent(F.count_if(F.col("k") == 1), F.count("*")), 2).alias("one_target_pct"),
    )


def target_correlation(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(variable, non_null, missing_pct, correlation, abs_correlation) on rows that have both values, strongest first."""
    report = wide_to_long(df, columns, {
        "non_null": lambda c: F.count(name(c)),
        "missing_pct": lambda c: percent(missing_count(c), F.count("*")),
        "correlation": lambda c: F.corr(
            F.when(name(target).isNotNull(), name(c).cast("double")), F.when(name(c).isNotNull(), name(target).cast("double"))
        ),
    })
    return report.withColumn("abs_correlation", F.abs("correlation")).orderBy(F.desc_nulls_last("abs_correlation"), "variable")


def eta_squared(df: DataFrame, target: str, categories: Sequence[str]) -> DataFrame:
    """(variable, groups, n, eta_squared): share of the target's variance between the groups of each category.

    One pass over the rows into (count, mean, squared deviation) per category value, then one over the groups.
    """
    y = name(target).cast("double")
    long = df.where(y.isNotNull()).select(y.alias("y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), as_text(df, c).alias("value")) for c in categories
    ])))
    groups = long.where("value is not null").groupBy("variable", "value").agg(
        F.count("*").alias("n"), F.avg("y").alias("m"), (F.var_pop("y") * F.count("*")).alias("within")
    )
    # group means against the mean of all their rows: no difference of two large sums
    means = groups.groupBy("variable").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    off = F.col("m") - F.col("mean")
    totals = groups.join(means, "variable").groupBy("variable").agg(
        F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.col("n") * off * off).alias("between"), F.sum("within").alias("within"),
    )
    share = F.coalesce(F.try_divide(F.col("between"), F.col("between") + F.col("within")), F.lit(0.0))
    return totals.select("variable", "groups", "n", share.alias("eta_squared"))
