"""Numeric, temporal and class expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"]


def parse_timestamp(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to timestamp by the first fitting format; text that fits none becomes missing."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def month_angle(c: Column) -> Column:
    return (F.month(c) - 1) * F.lit(2 * math.pi) / F.lit(12.0)


def present(c: Column) -> Column:
    return c.isNotNull().cast("byte")


def member(c: Column, values: Sequence[str]) -> Column:
    """Membership that is False, not missing, for a missing value, so that it can be negated."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def right_closed_class(c: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ]lower, upper] that holds the value, open at both ends of the scale."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    if list(bounds) != sorted(set(bounds)):
        raise ValueError("bounds must be strictly increasing")
    out = F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        out = out.when(c <= F.lit(float(bound)), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def right_closed_bin(c: Column, edges: Sequence[float]) -> Column:
    """Number 1..k of the interval ]edge, next edge] that holds the value; the first one also holds its lower end."""
    out = F.when(c.isNull() | (c < F.lit(float(edges[0]))) | (c > F.lit(float(edges[-1]))), F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:-1], start=1):
        out = out.when(c <= F.lit(float(upper)), F.lit(i))
    return out.otherwise(F.lit(len(edges) - 1))


def parse_bound(c: Column) -> Column:
    """Bound written as text, open ends as -inf and inf."""
    return (
        F.when(F.lower(c) == "-inf", F.lit(float("-inf")))
        .when(F.lower(c).isin("inf", "+inf"), F.lit(float("inf")))
        .otherwise(c.try_cast("double"))
    )


def is_infinite(c: Column) -> Column:
    return F.coalesce(F.abs(c.cast("double")) == F.lit(float("inf")), F.lit(False))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
