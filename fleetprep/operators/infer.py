"""Types of text columns from all their values, in one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetprep import contracts as K
from fleetprep.functions.text import name

# what a value may be, narrowest first; every value is the first of these that it fits
KINDS = ["missing", "whole", "decimal", "date", "text"]
WHOLE = r"\A[+-]?[0-9]{1,18}\z"
DECIMAL = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\z"
DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
SPARK_TYPES = {"empty": "string", "whole": "bigint", "decimal": "double", "date": "date", "text": "string"}


def kind(c: Column, missing_tokens: Sequence[str]) -> Column:
    """The kind of one value; whole numbers of over 18 digits are decimals, days that do not exist are text."""
    return (
        F.when(c.isNull() | c.isin(list(missing_tokens)), "missing").when(c.rlike(WHOLE), "whole").when(c.rlike(DECIMAL), "decimal")
        .when(c.rlike(DATE) & F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull(), "date").otherwise("text")
    )


def infer_types(df: DataFrame, columns: Sequence[str] | None = None, missing_tokens: Sequence[str] = K.MISSING_TOKENS) -> DataFrame:
    """(variable, type, missing, whole, decimal, date, text, counter_example) of each text column.

    Numbers of both kinds make a decimal column, dates alone a date column, everything else text; a column without values is empty. The counter-
    example of a text column that also holds numbers or dates is its smallest value that is neither, or that is the rarer kind of two.
    Counts of parts of a table add up, so one pass with map-side combine serves all columns.
    """
    columns = list(df.columns if columns is None else columns)
    cells = []
    for i, c in enumerate(columns):
        k = kind(name(c), missing_tokens)
        cells += [F.count_if(k == one).alias(f"{one}{i}") for one in KINDS]
        cells += [F.min(F.when(k == one, name(c))).alias(f"least_{one}{i}") for one in ("whole", "decimal", "date", "text")]
    one = df.agg(*cells)

    def row(i: int, c: str) -> Column:
        n = {one: F.col(f"{one}{i}") for one in KINDS}
        numbers = n["whole"] + n["decimal"]
        kind_of = (
            F.when(numbers + n["date"] + n["text"] == 0, "empty").when((n["text"] > 0) | ((n["date"] > 0) & (numbers > 0)), "text")
            .when(n["date"] > 0, "date").when(n["decimal"] > 0, "decimal").otherwise("whole")
        )
        number = F.least(F.col(f"least_whole{i}"), F.col(f"least_decimal{i}"))
        example = F.when((n["text"] > 0) & (numbers + n["date"] > 0), F.col(f"least_text{i}")).when(
            (n["text"] == 0) & (n["date"] > 0) & (numbers > 0), F.when(n["date"] <= numbers, F.col(f"least_date{i}")).otherwise(number)
        )
        return F.struct(F.lit(c).alias("variable"), kind_of.alias("type"), *[n[k].alias(k) for k in KINDS], example.alias("counter_example"))

    return one.select(F.inline(F.array(*[row(i, c) for i, c in enumerate(columns)])))


def types_of(df: DataFrame, columns: Sequence[str] | None = None, missing_tokens: Sequence[str] = K.MISSING_TOKENS) -> dict[str, str]:
    """Spark's type for each column."""
    return {r["variable"]: SPARK_TYPES[r["type"]] for r in infer_types(df, columns, missing_tokens).collect()}


def cast_to(df: DataFrame, types: Mapping[str, str], missing_tokens: Sequence[str] = K.MISSING_TOKENS) -> DataFrame:
    """Text columns in their types, missing tokens as missing values; other columns stay."""
    cells = {c: F.when(~name(c).isin(list(missing_tokens)), name(c)) for c in types}
    return df.withColumns({c: cells[c] if t == "string" else cells[c].try_cast(t) for c, t in types.items()})
