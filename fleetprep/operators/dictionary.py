"""Dictionaries of text columns with any number of values: made, ranked and joined by Spark, never collected."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.functions.text import name


def dictionary(counts: DataFrame) -> DataFrame:
    """(value, id) from (value, n), staged: ids from 0 without gaps, frequent values first, ties by the value.

    Values are dealt into ranges in that order; a value's id is its place in its range and the sizes of the ranges before it, of which there is
    one number a range.
    """
    order = [F.desc("n"), F.asc("value")]
    ranged = stage(counts.select("value", "n").repartitionByRange(*order).withColumn("piece", F.spark_partition_id()))
    sizes = {r["piece"]: r["n"] for r in ranged.groupBy("piece").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for piece in sorted(sizes):
        before[piece] = total
        total += sizes[piece]
    start = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(F.lit(0), F.lit(0))
    place = F.row_number().over(Window.partitionBy("piece").orderBy(*order)) - 1
    return stage(ranged.select("value", (place + F.element_at(start, F.col("piece"))).cast("long").alias("id")))


def encode(df: DataFrame, tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Each column replaced by `<column>_vector`, sparse, with a 1 at its value's id; unknown and missing values are all zeros.

    tables: column -> (dictionary, number of values). The joins are left to the engine: small dictionaries are broadcast, large ones
    shuffled, with skewed values split.
    """
    for c, (table, size) in tables.items():
        pair = table.select(F.col("value").alias(f"{c}__value"), F.col("id").alias(f"{c}__id"))
        df = df.join(pair, name(c) == name(f"{c}__value"), "left")
        df = df.withColumn(f"{c}__id", F.coalesce(name(f"{c}__id"), F.lit(size)).cast("double")).drop(f"{c}__value", c)
        known = df.sparkSession.createDataFrame([(float(max(size - 1, 0)),)], f"`{c}__id` double")
        encoder = OneHotEncoder(inputCols=[f"{c}__id"], outputCols=[f"{c}_vector"], handleInvalid="keep", dropLast=True).fit(known)
        df = encoder.transform(df).drop(f"{c}__id")
    return df


def load(spark: SparkSession, paths: Mapping[str, str], sizes: Mapping[str, int]) -> dict[str, tuple[DataFrame, int]]:
    return {c: (spark.read.schema("value string, id long").parquet(p), sizes[c]) for c, p in paths.items()}
