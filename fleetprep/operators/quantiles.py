"""Exact interpolated quantiles by counting, for any number of rows, distinct values and groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.functions.text import name


def quantiles(df: DataFrame, values: Mapping[str, Column], probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, q0, q1, ...): linearly interpolated quantiles of each value column, missing values left out.

    Values are counted with map-side combine. The counts - one row per group and different value - are dealt out in value order, which
    splits a group over as many pieces as its size asks for, and staged. The wanted positions are found among the pieces' totals; only the
    pieces that hold one are put in order. A group without values gets missing quantiles.
    """
    group = [*by, "variable"]
    keys = [name(g) for g in group]
    long = df.select(*[name(b) for b in by], F.inline(F.array(*[
        F.struct(F.lit(label).alias("variable"), c.cast("double").alias("value")) for label, c in values.items()
    ])))
    counts = long.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    counts = stage(counts.repartitionByRange(*keys, "value").withColumn("piece", F.spark_partition_id()))
    filled = counts.where("value is not null")

    pieces = filled.groupBy(*keys, "piece").agg(F.sum("n").alias("piece_n"), F.min("value").alias("least"))
    upto = Window.partitionBy(*keys).orderBy("least").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("before", F.sum("piece_n").over(upto) - F.col("piece_n"))
    pieces = pieces.withColumn("total", F.sum("piece_n").over(Window.partitionBy(*keys)))
    wanted = []
    for j, p in enumerate(probabilities):
        at = F.lit(float(p)) * (F.col("total") - 1)
        wanted += [F.struct(F.lit(j).alias("j"), e.alias("rank"), at.alias("at")) for e in (F.floor(at), F.ceil(at))]
    targets = pieces.withColumn("targets", F.filter(
        F.array(*wanted),
        lambda t: (t["rank"] >= F.col("before")) & (t["rank"] < F.col("before") + F.col("piece_n")),
    )).where(F.size("targets") > 0)
    key = [*group, "piece"]
    targets = targets.select(*[name(g).alias(f"t{k}") for k, g in enumerate(key)], "before", "targets")

    run = Window.partitionBy(*[name(g) for g in key]).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        filled.join(targets, [name(g).eqNullSafe(F.col(f"t{k}")) for k, g in enumerate(key)], "inner")
        .withColumn("last", F.sum("n").over(run) + F.col("before"))
        .withColumn("hit", F.explode(F.filter(
            "targets", lambda t: (t["rank"] >= F.col("last") - F.col("n")) & (t["rank"] < F.col("last"))
        )))
        .groupBy(*keys, F.col("hit.j").alias("j"), F.col("hit.at").alias("at"))
        .agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    share = F.col("at") - F.floor("at")
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise((1 - share) * F.col("lo") + share * F.col("hi"))
    # groups that have rows but no value, and whole columns even without rows
    present = counts.select(*keys).distinct()
    if not by:
        present = df.sparkSession.createDataFrame([(label,) for label in values], "variable string")
    missing = present.withColumn("j", F.lit(-1)).withColumn("value", F.lit(None).cast("double"))
    picked = found.select(*keys, "j", value.alias("value")).unionByName(missing)
    return picked.groupBy(*keys).agg(*[F.max(F.when(F.col("j") == j, F.col("value"))).alias(f"q{j}") for j in range(len(probabilities))])


def scalars(df: DataFrame, values: Mapping[str, Column], probabilities: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles of whole columns as numbers, for use as fitted values."""
    rows = quantiles(df, values, probabilities).collect()
    return {r["variable"]: [r[f"q{j}"] for j in range(len(probabilities))] for r in rows}
