"""CSV and Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep import contracts as K
from fleetprep.functions.text import name
from fleetprep.functions.values import DATE_FORMATS, nan_to_null
from fleetprep.operators.fingerprint import same_content
from fleetprep.operators.infer import cast_to, types_of
from fleetprep.operators.schema import parse_date_column, require_columns
from fleetprep.operators.shape import missing_count


def scan_csv_text(spark: SparkSession, path: str, missing_tokens: Sequence[str] = K.MISSING_TOKENS) -> DataFrame:
    """Comma-separated file with a header, every column as text, the missing tokens as missing values."""
    raw = spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    tokens = list(missing_tokens)
    return raw.select(*[F.when(~name(c).isin(tokens), name(c)).alias(c) for c in raw.columns])


def first_rows(df: DataFrame, key: str, rows: int | None) -> DataFrame:
    """The first rows in key order, the same ones whatever the order of the files."""
    return df if rows is None else df.orderBy(name(key)).limit(rows)


def typed(df: DataFrame, longs: Sequence[str], doubles: Sequence[str], names: Mapping[str, str] = {}) -> DataFrame:
    """Cast text columns by their canonical name; text that is no number becomes missing, as does not-a-number."""
    out = []
    for c in df.columns:
        canonical = names.get(c.strip(), c.strip())
        if canonical in longs:
            # whole numbers written as 12 or 12.0
            whole = F.coalesce(name(c).try_cast("bigint"), name(c).try_cast("double").try_cast("bigint"))
            out.append(whole.alias(c))
        elif canonical in doubles:
            out.append(nan_to_null(name(c).try_cast("double")).alias(c))
        else:
            out.append(name(c))
    return df.select(*out)


def scan_csv(spark: SparkSession, path: str, rows: int | None = None, key: str = "ID") -> DataFrame:
    """The source table under its source headers, typed; optionally its first rows."""
    return first_rows(typed(scan_csv_text(spark, path), K.LONG_COLUMNS, K.DOUBLE_COLUMNS, K.SOURCE_NAMES), key, rows)


def scan_csv_inferred(spark: SparkSession, path: str, missing_tokens: Sequence[str] = K.MISSING_TOKENS) -> DataFrame:
    """A comma-separated file with every column in the type that all its values have."""
    text = spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    return cast_to(text, types_of(text, missing_tokens=missing_tokens), missing_tokens)


def scan_csv_dates(
    spark: SparkSession, path: str, date: str = K.DATE, rows: int | None = None, key: str = K.KEY
) -> DataFrame:
    """The cleaned table back from CSV, its date column as a timestamp."""
    table = parse_date_column(typed(scan_csv_text(spark, path), K.LONG_COLUMNS, K.DOUBLE_COLUMNS), date, TIMESTAMP_FORMATS)
    return first_rows(table, key, rows)


TIMESTAMP_FORMATS = [*DATE_FORMATS, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"]


def scan_features(spark: SparkSession, path: str, rows: int | None = None, key: str = K.KEY) -> DataFrame:
    """The feature table back from CSV."""
    return first_rows(typed(scan_csv_text(spark, path), K.LONG_COLUMNS, [*K.NUMERIC_FEATURES, K.TARGET]), key, rows)


def head(table: DataFrame, rows: int) -> DataFrame:
    """The first rows of a Parquet table in the order of file names and places in the files.

    Rows per file come from the files' footers. The file in which the head ends is looked up in that index, and the condition on file
    names lets the scan list only the files up to it; nothing is sorted but the index.
    """
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    last, left = None, rows
    if rows > 0:
        for r in table.groupBy(path.alias("file")).agg(F.count("*").alias("n")).orderBy("file").toLocalIterator():
            last = r["file"]
            if r["n"] >= left:
                break
            left -= r["n"]
    if last is None:
        return table.where(F.lit(False))
    return table.where((path <= last) & ((path < last) | (place < left)))


def scan_parquet(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """All rows, or the first ones in the order of file names and places in the files; a table without rows is an error."""
    table = spark.read.parquet(path)
    if table.isEmpty():
        raise ValueError(f"no rows in {path}")
    return table if rows is None else head(table, rows)


def scan_target(spark: SparkSession, path: str, target: str, rows: int | None = None) -> DataFrame:
    """A table that holds exactly the target column."""
    table = scan_parquet(spark, path, rows)
    if table.columns != [target]:
        raise ValueError(f"expected the column {target} alone, found: " + ", ".join(table.columns))
    return table


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report has a few rows, so it becomes one file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_split(df: DataFrame, path: str, part: str = K.PART) -> None:
    """One dataset, one folder per part, so that a part is read without touching the others."""
    require_columns(df, [part])
    df.write.mode("overwrite").partitionBy(part).parquet(path)


def load_split(spark: SparkSession, path: str, parts: Sequence[str] = ("train", "test"), part: str = K.PART) -> DataFrame:
    """The split dataset; a missing or empty part is an error."""
    table = spark.read.parquet(path).withColumn(part, name(part).cast("string"))
    counts = {r[part]: r["n"] for r in table.groupBy(part).agg(F.count("*").alias("n")).collect()}
    absent = [p for p in parts if not counts.get(p)]
    if absent:
        raise ValueError("parts without rows: " + ", ".join(absent))
    return table


def xy(df: DataFrame, part_value: str, features: Sequence[str], target: str, part: str = K.PART) -> tuple[DataFrame, DataFrame]:
    """Features and target of one part, read through partition pruning."""
    rows = df.where(name(part) == part_value)
    return rows.select(*[name(c) for c in features]), rows.select(name(target))


def export_checks(written: DataFrame, read_back: DataFrame, target: str, date: str) -> DataFrame:
    """(check, ok): same row count, columns and contents, target there and complete, date still a timestamp."""
    here = target in read_back.columns
    date_kept = date in read_back.columns and isinstance(read_back.schema[date].dataType, T.TimestampType)
    a = written.agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("gaps"))
    b = read_back.agg((-F.count("*")).alias("rows"), (missing_count(target) if here else F.lit(1)).cast("bigint").alias("gaps"))
    same = same_content(written, read_back)
    both = a.unionByName(b).agg((F.sum("rows") == 0).alias("rows"), (F.sum("gaps") == 0).alias("gaps"))
    return both.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("check"), ok.alias("ok")) for label, ok in [
            ("row_count", F.col("rows")),
            ("columns", F.lit(sorted(written.columns) == sorted(read_back.columns))),
            ("content", F.lit(same)),
            ("target_present", F.lit(here)),
            ("target_complete", F.col("gaps")),
            ("date_type", F.lit(date_kept)),
        ]
    ])))


def report_checks(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(report, rows, ok): every report reads back with at least one row."""
    out = []
    for label, path in paths.items():
        try:
            n = spark.read.option("header", True).csv(path).count()
        except Exception:  # an absent or unreadable report is a failed check, not a crash
            n = 0
        out.append((label, n, n > 0))
    return spark.createDataFrame(out, "report string, rows bigint, ok boolean")
