"""Named quality checks: every group gives (check, ok) rows; enforce() turns failures into an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep.functions.text import is_digits, name
from fleetprep.functions.values import is_infinite
from fleetprep.operators.profile import duplicate_rows, identifier_check
from fleetprep.operators.shape import missing_count, numeric_columns, wide_to_long


def rows_of(df: DataFrame, tests: Mapping[str, Column | bool]) -> DataFrame:
    """(check, ok) rows; a Column is an aggregate, all of them taken in one pass, a bool is known already."""
    items = list(tests.items())
    aggregates = [(t if isinstance(t, Column) else F.lit(bool(t))) for _, t in items]
    one = df.agg(F.count("*").alias("_rows"), *[t.alias(f"t{i}") for i, t in enumerate(aggregates)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("check"), F.coalesce(F.col(f"t{i}").cast("boolean"), F.lit(False)).alias("ok"))
        for i, (label, _) in enumerate(items)
    ])))


def enforce(checks: DataFrame) -> None:
    failed = sorted(r["check"] for r in checks.where(~F.col("ok")).collect())
    if failed:
        raise ValueError("failed checks: " + ", ".join(failed))


def nothing(condition: Column) -> Column:
    return F.count_if(condition) == 0


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def any_missing(columns: Sequence[str]) -> Column:
    return any_of([name(c).isNull() for c in columns])


def cleaned_checks(
    df: DataFrame, required: Sequence[str], key: str, target: str, date: str, make: str, upper_codes: Sequence[str]
) -> DataFrame:
    here = set(df.columns)
    missing = sorted(set(required) - here)
    have = lambda c, test: test() if c in here else False
    tests: dict[str, Column | bool] = {
        "required_columns": not missing,
        "key_complete": have(key, lambda: nothing(name(key).isNull())),
        "target_complete": have(target, lambda: nothing(name(target).isNull())),
        "date_is_timestamp": date in here and isinstance(df.schema[date].dataType, T.TimestampType),
        "no_numeric_make": have(make, lambda: nothing(is_digits(name(make)))),
    }
    for c in upper_codes:
        if c in here:
            tests[f"upper_case:{c}"] = nothing(name(c) != F.upper(name(c)))
    # rows with a complete and unique key cannot be copies of each other, so the whole rows are compared only without one
    ids = identifier_check(df, key).first() if key in here else None
    unique = ids is not None and ids["duplicated"] == 0
    tests["key_unique"] = unique
    if unique:
        return rows_of(df, tests | {"no_duplicate_rows": True})
    out = rows_of(df, tests)
    copies = duplicate_rows(df).select(F.lit("no_duplicate_rows").alias("check"), (F.col("duplicated") == 0).alias("ok"))
    return out.unionByName(copies)


def feature_checks(
    df: DataFrame, target: str, excluded: Sequence[str], temporal: Sequence[str], contract: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    columns = [c for c in df.columns if c not in ignore]
    present = [c for c in temporal if c in columns]
    tests: dict[str, Column | bool] = {
        "target_present": target in columns,
        "unique_names": len(columns) == len(set(columns)),
        "excluded_absent": not set(excluded) & set(columns),
    }
    for c in temporal:
        tests[f"present:{c}"] = c in columns
    tests["temporal_complete"] = nothing(any_missing(present)) if len(present) == len(temporal) else False
    tests["contract_columns"] = set(columns) == set(contract)
    tests["column_count"] = len(columns) == len(contract)
    return rows_of(df, tests)


def matrix_checks(
    df: DataFrame, part: str, features: Sequence[str], target: str, originals: Sequence[str],
    excluded: Sequence[str], indicators: Sequence[str],
) -> DataFrame:
    """Checks of the prepared matrix; both parts are columns of one table, so their names agree by construction."""
    numeric = set(numeric_columns(df))
    have = [c for c in features if c in df.columns]
    flags = [c for c in indicators if c in df.columns]
    tests: dict[str, Column | bool] = {}
    for p in ("train", "test"):
        mine = name(part) == p
        tests[f"no_missing:{p}"] = nothing(mine & any_missing(have))
        tests[f"no_infinite:{p}"] = nothing(mine & any_of([is_infinite(name(c)) for c in have if c in numeric]))
        tests[f"rows_match:{p}"] = F.count_if(mine) == F.count(F.when(mine, name(target)))
    tests |= {
        "same_columns": have == list(features),
        "all_numeric": all(c in numeric for c in have),
        "originals_absent": not set(originals) & set(df.columns),
        "excluded_absent": not set(excluded) & set(df.columns),
        "indicators_binary": (
            nothing(any_of([~F.coalesce(name(c).isin(0, 1), F.lit(False)) for c in flags]))
            if len(flags) == len(indicators) else False
        ),
    }
    return rows_of(df, tests)


def training_checks(df: DataFrame, part: str, features: Sequence[str], target: str, excluded: Sequence[str], infinite: bool) -> DataFrame:
    """Checks before a fit: 12 for regression, 9 for classification, which tests infinities instead of names and types."""
    numeric = set(numeric_columns(df))
    have = [c for c in features if c in df.columns]
    tests: dict[str, Column | bool] = {"same_columns": have == list(features)}
    for p in ("train", "test"):
        mine = name(part) == p
        tests[f"rows_match:{p}"] = F.count_if(mine) == F.count(F.when(mine, name(target)))
        tests[f"no_missing_x:{p}"] = nothing(mine & any_missing(have))
        tests[f"no_missing_y:{p}"] = nothing(mine & name(target).isNull())
        if infinite:
            tests[f"no_infinite:{p}"] = nothing(mine & any_of([is_infinite(name(c)) for c in have if c in numeric]))
        else:
            tests[f"target_absent:{p}"] = target not in features
            tests[f"all_numeric:{p}"] = all(c in numeric for c in have)
    if not infinite:
        tests["excluded_absent"] = not any(e in c.lower() for e in excluded for c in features)
    return rows_of(df, tests)


def input_checks(df: DataFrame, required: Sequence[str], numeric: Sequence[str], target: str) -> DataFrame:
    here = df.columns
    types = set(numeric_columns(df))
    tests: dict[str, Column | bool] = {
        "required_columns": not set(required) - set(here),
        "unique_names": len(here) == len(set(here)),
        "numeric_types": all(c in types for c in [*numeric, target]),
        "target_complete": nothing(name(target).isNull()) if target in here else False,
        "target_finite": nothing(is_infinite(name(target))) if target in here and target in types else False,
    }
    return rows_of(df, tests)


def treatment_status(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """(variable, missing_train, missing_test, status): OK when nothing is missing in either part."""
    here = [c for c in columns if c in df.columns]
    report = wide_to_long(df, here, {
        "missing_train": lambda c: F.count_if((name(part) == "train") & name(c).isNull()),
        "missing_test": lambda c: F.count_if((name(part) == "test") & name(c).isNull()),
    })
    clean = (F.col("missing_train") == 0) & (F.col("missing_test") == 0)
    return report.withColumn("status", F.when(clean, "OK").otherwise("to check"))


def remaining_missing(df: DataFrame, columns: Sequence[str], total: str = "(all)") -> DataFrame:
    """(variable, missing) of the columns that still have gaps, and the sum over all columns under its own name."""
    gaps = wide_to_long(df, columns, {"missing": missing_count})
    every = gaps.agg(F.sum("missing").alias("missing")).select(F.lit(total).alias("variable"), "missing")
    return gaps.where("missing > 0").unionByName(every)


def indicator_consistency(df: DataFrame, part: str, indicators: Mapping[str, str]) -> DataFrame:
    """(part, variable, indicator_zeros, missing, ok): a flag is 0 exactly where the original value is missing.

    Expects the flags beside the original, not yet imputed columns.
    """
    flags = dict(indicators)
    report = wide_to_long(df, list(flags), {
        "indicator_zeros": lambda c: F.count_if(name(flags[c]) == 0),
        "missing": missing_count,
    }, by=[part])
    return report.withColumn("ok", F.col("indicator_zeros") == F.col("missing"))
