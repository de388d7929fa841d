"""Turning one wide row of aggregates, or many columns, into long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep.functions.text import name


def as_text(df: DataFrame, column: str) -> Column:
    """Value as text so that columns of all types share one long form; equal values give equal text."""
    c = name(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        c = c + F.lit(0.0)  # -0.0 and 0.0 are one value
    return c.cast("string")


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row (kept columns, variable, value as text) per row and column."""
    flat = df.select(*[name(k) for k in keep], *[as_text(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"v{i}").alias("value")) for i, c in enumerate(columns)])
    return flat.select(*[name(k) for k in keep], F.inline(pairs))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value, n): rows per distinct value of each column, missing kept as a value.

    The counting is combined before the shuffle, so a value held by many rows travels once per task.
    """
    return long_values(df, columns).groupBy("variable", "value").agg(F.count("*").alias("n"))


def wide_to_long(
    df: DataFrame,
    columns: Sequence[str],
    measures: Mapping[str, "callable"],
    by: Sequence[str] = (),
    label: str = "variable",
) -> DataFrame:
    """Aggregate every column with every measure in one pass, then one output row per column.

    measures maps an output name to a function column name -> aggregate Column.
    """
    aggregates, structs = [], []
    for i, column in enumerate(columns):
        fields = [F.lit(column).alias(label)]
        for j, (alias, build) in enumerate(measures.items()):
            aggregates.append(build(column).alias(f"a{i}_{j}"))
            fields.append(F.col(f"a{i}_{j}").alias(alias))
        structs.append(F.struct(*fields))
    grouped = df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)
    return grouped.select(*[name(b) for b in by], F.inline(F.array(*structs)))


def missing_count(column: str) -> Column:
    return F.count_if(name(column).isNull())


def kind_of(df: DataFrame, column: str) -> str:
    return "numeric" if isinstance(df.schema[column].dataType, T.NumericType) else "categorical"


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def type_names(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def with_type(report: DataFrame, types: Mapping[str, str], label: str = "variable") -> DataFrame:
    """Add the declared type of each variable to a report keyed by variable name."""
    table = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return report.withColumn("dtype", F.element_at(table, F.col(label)))
