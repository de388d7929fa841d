"""Cleaned table to feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep import contracts as K
from fleetprep.cluster import one_row, stage
from fleetprep.functions.text import name
from fleetprep.functions.values import month_angle
from fleetprep.operators.checks import enforce, feature_checks
from fleetprep.operators.schema import require_columns, require_unique_names, select_contract
from fleetprep.operators.shape import missing_count
from fleetprep.sources.tables import scan_csv_dates, write_csv


def require_input(df: DataFrame) -> None:
    require_columns(df, K.FEATURE_REQUIRED)
    require_unique_names(df)
    if not isinstance(df.schema[K.DATE].dataType, T.TimestampType):
        raise TypeError(f"{K.DATE} must be a timestamp")
    if one_row(df, {"n": missing_count(K.TARGET)})["n"]:
        raise ValueError(f"missing values in {K.TARGET}")


def temporal_features(df: DataFrame, date: str, out: Sequence[str] = tuple(K.TEMPORAL_FEATURES)) -> DataFrame:
    """Sine and cosine of the month on a circle; a row without month is an error."""
    if one_row(df, {"n": missing_count(date)})["n"]:
        raise ValueError(f"rows without month in {date}")
    angle = month_angle(name(date))
    return df.withColumns({out[0]: F.sin(angle), out[1]: F.cos(angle)})


def build(df: DataFrame, keep: Sequence[str] = (K.KEY,)) -> DataFrame:
    """The 15 contract columns, with the key in front that stands for the row index."""
    require_input(df)
    return select_contract(temporal_features(df, K.DATE), K.FEATURE_EXCLUDED, K.FEATURE_OUTPUT, keep)


def checks(df: DataFrame) -> DataFrame:
    return feature_checks(df, K.TARGET, K.FEATURE_EXCLUDED, K.TEMPORAL_FEATURES, K.FEATURE_OUTPUT, ignore=[K.KEY])


def feature_job(spark: SparkSession, source: str, target: str, rows: int | None = None) -> DataFrame:
    result = build(stage(scan_csv_dates(spark, source, rows=rows)))
    enforce(checks(result))
    write_csv(result, target)
    return result
