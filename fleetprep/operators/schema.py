"""Column selection, naming and typing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep.cluster import one_row
from fleetprep.functions.text import name
from fleetprep.functions.values import DATE_FORMATS, nan_to_null, parse_timestamp
from fleetprep.operators.shape import kind_of, missing_count, type_names, wide_to_long


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))


def require_unique_names(df: DataFrame) -> None:
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated:
        raise ValueError("repeated column names: " + ", ".join(repeated))


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without any value, in one pass."""
    filled = one_row(df, {f"c{i}": F.count(name(c)) for i, c in enumerate(df.columns)})
    return [c for i, c in enumerate(df.columns) if not filled[f"c{i}"]]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    return df.drop(*empty_columns(df))


def normalize_column_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Trim the names, then rename those the map knows."""
    trimmed = [c.strip() for c in df.columns]
    return df.toDF(*[names.get(c, c) for c in trimmed])


def parse_date_column(df: DataFrame, column: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Text to timestamp, unreadable text to missing. A column that is a timestamp already stays as it is."""
    if column not in df.columns:
        raise KeyError(f"missing column: {column}")
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return df
    return df.withColumn(column, parse_timestamp(name(column).cast("string"), formats))


def is_constant(column: str) -> Column:
    """At most one distinct value, missing counted as one: smallest equals largest and no gap, or nothing but gaps."""
    v = name(column)
    return F.min(v).eqNullSafe(F.max(v)) & F.count(v).isin(F.lit(0), F.count("*"))


def constant_columns(df: DataFrame) -> list[str]:
    """Constant columns in one pass of smallest, largest and count, without counting distinct values."""
    found = one_row(df, {f"c{i}": is_constant(c) for i, c in enumerate(df.columns)})
    return [c for i, c in enumerate(df.columns) if found[f"c{i}"]]


def drop_constant_columns(df: DataFrame, protected: Sequence[str] = (), drop: bool = True) -> tuple[DataFrame, list[str]]:
    """Drop the constant columns that are not protected; the full list of constant columns is returned too."""
    constant = constant_columns(df)
    return (df.drop(*[c for c in constant if c not in protected]) if drop else df), constant


def constant_report(df: DataFrame, protected: Sequence[str] = ()) -> DataFrame:
    """(variable, constant, protected) for every column."""
    report = wide_to_long(df, df.columns, {"constant": is_constant})
    return report.withColumn("protected", F.col("variable").isin(list(protected)))


def select_contract(df: DataFrame, excluded: Sequence[str], contract: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Leave out the excluded columns, then keep exactly the contract set in source order.

    keep names key columns that stay in front although the contract does not list them.
    """
    left = [c for c in df.columns if c not in set(excluded)]
    missing = sorted(set(contract) - set(left))
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df.select(*[name(c) for c in keep], *[name(c) for c in left if c in set(contract) and c not in set(keep)])


def split_xy(df: DataFrame, target: str, excluded: Sequence[str] = (), key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Features and target as two projections; the key stays in both so that they can be paired again."""
    require_columns(df, [target])
    keys = [key] if key else []
    x = [c for c in df.columns if c != target and c not in set(excluded) and c not in keys]
    left_over = set(x) & {target, *excluded}
    if left_over:
        raise ValueError("not excluded: " + ", ".join(sorted(left_over)))
    return df.select(*[name(c) for c in [*keys, *x]]), df.select(*[name(c) for c in [*keys, target]])


def column_kinds(df: DataFrame) -> DataFrame:
    """(variable, kind, non_null): every column is either numeric or categorical."""
    kinds = {c: kind_of(df, c) for c in df.columns}
    report = wide_to_long(df, df.columns, {"non_null": lambda c: F.count(name(c))})
    table = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return report.withColumn("kind", F.element_at(table, F.col("variable")))


def variable_registry(df: DataFrame, rules: Sequence[tuple[Column, str, str, str]], otherwise: tuple[str, str, str]) -> DataFrame:
    """(variable, dtype, role, decision, rationale, missing).

    rules is a table of (condition, role, decision, rationale); a condition may use the columns variable, missing and constant. Each
    variable gets the entries of its first rule that holds, or those of otherwise.
    """
    report = wide_to_long(df, df.columns, {"missing": missing_count, "constant": is_constant})
    entry = lambda texts: F.struct(*[F.lit(t).alias(k) for k, t in zip(("role", "decision", "rationale"), texts)])
    found = F.coalesce(*[F.when(condition, entry(texts)) for condition, *texts in rules], entry(otherwise))
    dtypes = F.create_map(*[F.lit(x) for pair in type_names(df).items() for x in pair])
    return report.withColumn("entry", found).select(
        "variable", "missing", "entry.*", F.element_at(dtypes, F.col("variable")).alias("dtype")
    )


def nan_free(df: DataFrame) -> DataFrame:
    """Every not-a-number in a floating column becomes missing."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(name(c)) for c in floats}) if floats else df
