"""Source table to cleaned table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetprep import contracts as K
from fleetprep.cluster import stage
from fleetprep.functions.text import name
from fleetprep.operators.checks import cleaned_checks, enforce
from fleetprep.operators.makes import alias_counts, apply_aliases, normalize_make, normalize_text
from fleetprep.operators.schema import drop_constant_columns, drop_empty_columns, nan_free, normalize_column_names, parse_date_column
from fleetprep.sources.tables import export_checks, scan_csv, scan_csv_dates, write_csv


@dataclass
class Cleaned:
    rows: DataFrame
    make_report: DataFrame
    alias_report: DataFrame
    constants: list[str]


def clean(df: DataFrame, drop_constant: bool = True) -> Cleaned:
    """Not-a-number, empty columns, names, dates, text and codes, makes, aliases, constant columns, rows without target.

    Three aggregations decide the schema and the lookups (empty columns, counts of makes, constant columns); what is
    returned is one lazy projection and two lookup joins over the source.
    """
    named = normalize_column_names(drop_empty_columns(nan_free(df)), K.SOURCE_NAMES)
    text = normalize_text(parse_date_column(named, K.DATE), K.UPPER_CODES)
    made, report = normalize_make(text, K.MAKE, K.MAKER_EU, K.MAKER_OEM, K.MIN_PAIR_SHARE)
    aliases = alias_counts(made, K.MAKE, K.MAKE_ALIASES)
    kept, constants = drop_constant_columns(
        apply_aliases(made, K.MAKE, K.MAKE_ALIASES), [*K.CLEAN_REQUIRED, K.TARGET], drop_constant
    )
    if K.TARGET not in kept.columns:
        raise KeyError(f"missing column: {K.TARGET}")
    return Cleaned(kept.where(name(K.TARGET).isNotNull()), report, aliases, constants)


def checks(df: DataFrame) -> DataFrame:
    return cleaned_checks(df, K.CLEAN_REQUIRED, K.KEY, K.TARGET, K.DATE, K.MAKE, K.UPPER_CODES)


def clean_job(spark: SparkSession, source: str, target: str, rows: int | None = None, drop_constant: bool | None = None) -> DataFrame:
    """CSV to CSV. Unless drop_constant says otherwise, constant columns are kept with a row limit, because a part of the rows proves nothing."""
    # the cleaning looks at a few columns several times, so the text is parsed once
    source_rows = stage(scan_csv(spark, source, rows))
    result = stage(clean(source_rows, drop_constant=rows is None if drop_constant is None else drop_constant).rows)
    enforce(checks(result))
    write_csv(result, target)
    back = scan_csv_dates(spark, target)
    enforce(export_checks(result, back, K.TARGET, K.DATE))
    return back
