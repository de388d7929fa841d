"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep.functions.text import name


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(label: str, oracle: str | None = None):
    def register(run):
        if label in QUERIES:
            raise ValueError(f"query {label} is registered twice")
        QUERIES[label] = Query(lambda spark, sf_dir: tidy(run(spark, sf_dir)), oracle)
        return run

    return register


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: doubles to 6 places, whole numbers as bigint, times as text."""
    out = []
    for f in df.schema.fields:
        c = name(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(x: str) -> str:
    """The SQL side of tidy for a double."""
    return f"round(CAST({x} AS DOUBLE), 6) + CAST(0 AS DOUBLE)"


def n(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def pct(part: str, whole: str) -> str:
    return f"coalesce(100.0 * CAST({part} AS DOUBLE) / nullif({whole}, 0), 0)"
