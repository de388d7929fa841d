"""Profiles of a table: missing values, distinct values, frequencies, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.functions.text import is_code_like, is_digits, name, strip
from fleetprep.functions.values import percent
from fleetprep.operators.quantiles import quantiles
from fleetprep.operators.shape import (
    kind_of,
    long_values,
    missing_count,
    text_columns,
    type_names,
    value_counts,
    wide_to_long,
    with_type,
)


def overview(df: DataFrame) -> DataFrame:
    """(variable, rows, columns, non_null) for every column."""
    return wide_to_long(df, df.columns, {
        "rows": lambda c: F.count("*"),
        "non_null": lambda c: F.count(name(c)),
    }).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))


def missingness(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = False) -> DataFrame:
    """(variable, dtype, missing, missing_pct, all_missing), most missing first."""
    columns = list(columns or df.columns)
    report = wide_to_long(df, columns, {
        "missing": missing_count,
        "missing_pct": lambda c: percent(missing_count(c), F.count("*")),
        "all_missing": lambda c: F.count(name(c)) == 0,
    })
    if only_missing:
        report = report.where("missing > 0")
    return with_type(report, {c: type_names(df)[c] for c in columns}).orderBy(F.desc("missing_pct"), "variable")


def distinct_report(df: DataFrame, columns: Sequence[str] | None = None, count_missing: bool = False) -> DataFrame:
    """(variable, distinct_values, missing, rows): missing counts as one more value on request.

    One shuffle on (variable, value) for all columns, combined before it moves.
    """
    counts = value_counts(df, list(columns or df.columns))
    filled, empty = F.col("value").isNotNull(), F.col("value").isNull()
    distinct = F.count("*") if count_missing else F.count_if(filled)
    return counts.groupBy("variable").agg(
        distinct.alias("distinct_values"),
        F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("missing"),
        F.sum("n").alias("rows"),
    )


def type_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    report = distinct_report(df, columns).withColumn("missing_pct", F.round(percent(F.col("missing"), F.col("rows")), 2))
    return with_type(report, {c: type_names(df)[c] for c in columns}).drop("rows")


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None, count_missing: bool = False) -> DataFrame:
    """(variable, distinct_values, missing, missing_pct), fewest distinct values first."""
    report = distinct_report(df, list(columns or text_columns(df)), count_missing)
    return (
        report.withColumn("missing_pct", percent(F.col("missing"), F.col("rows"))).drop("rows")
        .orderBy("distinct_values", "variable")
    )


def cardinality_level(distinct: Column, limits: tuple[int, int]) -> Column:
    low, medium = limits
    return F.when(distinct <= low, "low").when(distinct <= medium, "medium").otherwise("high")


def with_cardinality(summary: DataFrame, limits: tuple[int, int]) -> DataFrame:
    return summary.withColumn("cardinality_level", cardinality_level(F.col("distinct_values"), limits))


def with_encoding(summary: DataFrame, encodings: Mapping[str, str]) -> DataFrame:
    table = F.create_map(*[F.lit(x) for pair in encodings.items() for x in pair])
    return summary.withColumn("recommended_encoding", F.element_at(table, F.col("cardinality_level")))


def value_frequencies(df: DataFrame, columns: Sequence[str], max_distinct: int) -> DataFrame:
    """(variable, value, n, pct) of the columns with at most max_distinct values, missing kept as a value."""
    counts = value_counts(df, columns)
    low = counts.groupBy("variable").agg(F.count("*").alias("d"), F.sum("n").alias("rows")).where(F.col("d") <= max_distinct)
    # one row per column of the table on this side
    return counts.join(F.broadcast(low), "variable").select(
        "variable", "value", "n", percent(F.col("n"), F.col("rows")).alias("pct")
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows, duplicated, duplicated_pct): rows beyond the first of each group of equal rows; missing equals missing.

    Row hashes are counted first; only rows whose hash repeats are compared in full, copies being combined before the shuffle.
    """
    columns = list(columns or df.columns)
    flat = df.select(*[name(c) for c in columns]).withColumn("_h", F.xxhash64(*[name(c) for c in columns]))
    counted = stage(flat.groupBy("_h").agg(F.count("*").alias("_n")))
    suspects = flat.join(counted.where("_n > 1").select("_h"), "_h", "left_semi")
    copies = suspects.groupBy("_h", *[name(c) for c in columns]).agg((F.count("*") - 1).alias("_extra"))
    rows = F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")
    both = counted.agg(rows, F.lit(0).cast("bigint").alias("duplicated")).unionByName(
        copies.agg(F.lit(0).cast("bigint").alias("rows"), F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicated"))
    ).agg(F.sum("rows").alias("rows"), F.sum("duplicated").alias("duplicated"))
    return both.withColumn("duplicated_pct", percent(F.col("duplicated"), F.col("rows")))


def identifier_check(df: DataFrame, key: str) -> DataFrame:
    """(rows, missing, distinct_values, duplicated) of an identifier column."""
    k = name(key)
    counts = df.groupBy(k.alias("k")).agg(F.count("*").alias("n"))
    filled = F.col("k").isNotNull()
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(filled).alias("distinct_values"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicated"),
    )


def identifier_uniqueness(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """(variable, dtype, missing, distinct_values, uniqueness_pct) of the candidates that exist."""
    columns = [c for c in candidates if c in df.columns]
    report = distinct_report(df, columns)
    rate = F.round(percent(F.col("distinct_values"), F.col("rows") - F.col("missing")), 2)
    report = report.withColumn("uniqueness_pct", rate).drop("rows")
    return with_type(report, {c: type_names(df)[c] for c in columns}).orderBy(F.desc("uniqueness_pct"), "variable")


def missing_by_group(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """One row per group (a missing group is a group), one percentage column per column."""
    return df.groupBy(name(group)).agg(
        *[(F.avg(name(c).isNull().cast("int")) * 100).alias(c) for c in columns]
    )


def missing_by_group_long(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """(group, variable, observations, missing, missing_pct)."""
    return wide_to_long(df, columns, {
        "observations": lambda c: F.count("*"),
        "missing": missing_count,
        "missing_pct": lambda c: percent(missing_count(c), F.count("*")),
    }, by=[group])


def missing_pct_of(report: DataFrame, group: str, group_value: str, variable: str) -> float | None:
    """One cell of missing_by_group_long, None for a group that does not occur."""
    row = report.where((name(group) == group_value) & (F.col("variable") == variable)).select("missing_pct").first()
    return None if row is None else row[0]


def unexpected_missing(df: DataFrame, group: str, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """(group, variable, rows, missing, missing_pct) for the columns that should be filled in a group; 0 if it is empty.

    All rules are counted in one pass over the rows.
    """
    g = name(group)
    aggregates, structs = [], []
    for i, (value, columns) in enumerate(expected.items()):
        aggregates.append(F.count_if(g == value).alias(f"n{i}"))
        for j, c in enumerate(columns):
            aggregates.append(F.count_if((g == value) & name(c).isNull()).alias(f"m{i}_{j}"))
            structs.append(F.struct(
                F.lit(value).alias(group),
                F.lit(c).alias("variable"),
                F.col(f"n{i}").alias("rows"),
                F.col(f"m{i}_{j}").alias("missing"),
                F.round(percent(F.col(f"m{i}_{j}"), F.col(f"n{i}")), 2).alias("missing_pct"),
            ))
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """(variable, rows, missing, missing_pct, distinct_values, min, median, mean, max)."""
    t = name(target)
    counts = df.groupBy(t.alias("t")).agg(F.count("*").alias("n"))
    filled = F.col("t").isNotNull()
    total = F.sum("n")
    summary = counts.agg(
        total.alias("rows"),
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(filled).alias("distinct_values"),
        F.min("t").alias("min"),
        F.try_divide(F.sum(F.col("t") * F.col("n")), F.sum(F.when(filled, F.col("n")))).alias("mean"),
        F.max("t").alias("max"),
    ).withColumn("variable", F.lit(target))
    median = quantiles(df, {target: t}, [0.5]).withColumnRenamed("q0", "median")
    return summary.withColumn("missing_pct", percent(F.col("missing"), F.col("rows"))).join(median, "variable")


def target_by_group(df: DataFrame, target: str, group: str) -> DataFrame:
    """Per group: rows, missing, zero, mean, median, min, max, zero_pct, missing_pct; a missing group is a group."""
    t = name(target)
    summary = df.groupBy(name(group).alias("g")).agg(
        F.count("*").alias("rows"),
        missing_count(target).alias("missing"),
        F.count_if(t == 0).alias("zeros"),
        F.avg(t).alias("mean"),
        F.min(t).alias("min"),
        F.max(t).alias("max"),
    )
    medians = quantiles(df.select(name(group).alias("g2"), t), {target: t}, [0.5], by=["g2"])
    return (
        summary.join(medians, F.col("g").eqNullSafe(F.col("g2")))
        .select(
            F.col("g").alias(group), "rows", "missing", "zeros", "mean", F.col("q0").alias("median"), "min", "max",
            percent(F.col("zeros"), F.col("rows")).alias("zero_pct"),
            percent(F.col("missing"), F.col("rows")).alias("missing_pct"),
        )
    )


def top_groups(df: DataFrame, group: str, target: str, n: int = 20) -> DataFrame:
    """Statistics of the n most frequent groups among rows that have both values."""
    t = name(target)
    stats = df.dropna(subset=[group, target]).groupBy(name(group)).agg(
        F.count("*").alias("n"), F.avg(t).alias("mean"), F.stddev_samp(t).alias("std"), F.min(t).alias("min"), F.max(t).alias("max")
    )
    return stats.orderBy(F.desc("n"), name(group)).limit(n)


DESCRIBE_PERCENTS = [1, 5, 25, 50, 75, 95, 99]


def describe(df: DataFrame, columns: Sequence[str], percents: Sequence[float] = DESCRIBE_PERCENTS) -> DataFrame:
    """(variable, n, mean, std, min, p.., max)."""
    moments = wide_to_long(df, columns, {
        "n": lambda c: F.count(name(c)),
        "mean": lambda c: F.avg(name(c)),
        "std": lambda c: F.stddev_samp(name(c)),
        "min": lambda c: F.min(name(c)),
        "max": lambda c: F.max(name(c)),
    })
    cuts = quantiles(df, {c: name(c) for c in columns}, [p / 100 for p in percents])
    cuts = cuts.withColumnsRenamed({f"q{j}": f"p{p}" for j, p in enumerate(percents)})
    return moments.join(cuts, "variable")


def distribution_summary(df: DataFrame, column: str) -> DataFrame:
    """(variable, min, q1, median, mean, q3, max, std, skewness), the skewness corrected for its bias."""
    c, n = name(column), F.count(name(column)).cast("double")
    corrected = F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))
    moments = df.agg(
        F.min(c).alias("min"), F.avg(c).alias("mean"), F.max(c).alias("max"),
        F.stddev_samp(c).alias("std"), corrected.alias("skewness"),
    ).withColumn("variable", F.lit(column))
    cuts = quantiles(df, {column: c}, [0.25, 0.5, 0.75])
    cuts = cuts.select("variable", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    return moments.join(cuts, "variable")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, lo, hi, n): equal-width bins from smallest to largest value, the last one closed; empty bins are listed."""
    c = name(column)
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    slot = F.least(F.floor((c - F.lit(float(lo))) / F.lit(float(width))), F.lit(bins - 1)).cast("int")
    counted = df.where(c.isNotNull()).groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(float(lo)) + F.col("id") * F.lit(float(width))).alias("lo"),
        (F.lit(float(lo)) + (F.col("id") + 1) * F.lit(float(width))).alias("hi"),
    )
    return frame.join(counted, "bin", "left").fillna(0, ["n"])


def box_summary(df: DataFrame, column: str) -> DataFrame:
    """(q1, median, q3, whisker_lo, whisker_hi, outliers): whiskers end at the last value within 1.5 box lengths."""
    c = name(column)
    row = quantiles(df, {column: c}, [0.25, 0.5, 0.75]).first()
    q1, median, q3 = (F.lit(row[f"q{j}"]).cast("double") for j in range(3))
    reach = F.lit(1.5) * (q3 - q1)
    inside = c.between(q1 - reach, q3 + reach)
    return df.agg(
        F.min(F.when(inside, c)).alias("whisker_lo"),
        F.max(F.when(inside, c)).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"),
    ).select(q1.alias("q1"), median.alias("median"), q3.alias("q3"), "whisker_lo", "whisker_hi", "outliers")


def tail_above_quantile(df: DataFrame, column: str, probability: float) -> DataFrame:
    """(threshold, n, pct, max): rows strictly above the quantile."""
    c = name(column)
    threshold = F.lit(quantiles(df, {column: c}, [probability]).first()["q0"]).cast("double")
    above = c > threshold
    return df.agg(
        F.count_if(above).alias("n"), percent(F.count_if(above), F.count(c)).alias("pct"), F.max(F.when(above, c)).alias("max")
    ).select(threshold.alias("threshold"), "n", "pct", "max")


def candidate_analysis(df: DataFrame, target: str) -> DataFrame:
    """(variable, dtype, distinct_values incl. missing, missing_pct, distinct_ratio_pct), most distinct first."""
    columns = [c for c in df.columns if c != target]
    report = distinct_report(df, columns, count_missing=True).select(
        "variable", "distinct_values",
        percent(F.col("missing"), F.col("rows")).alias("missing_pct"),
        percent(F.col("distinct_values"), F.col("rows")).alias("distinct_ratio_pct"),
    )
    return with_type(report, {c: type_names(df)[c] for c in columns}).orderBy(F.desc("distinct_values"), "variable")


def sample_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """(variable, distinct_values, missing_pct, values): the n smallest values of each column, never more per task."""
    counts = value_counts(df, columns)
    report = counts.groupBy("variable").agg(
        F.count_if(F.col("value").isNotNull()).alias("distinct_values"),
        F.round(percent(F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)), F.sum("n")), 2).alias("missing_pct"),
    )
    first = Window.partitionBy("variable").orderBy("value")
    samples = (
        counts.where("value is not null").withColumn("r", F.row_number().over(first)).where(F.col("r") <= n)
        .groupBy("variable").agg(F.array_sort(F.collect_list("value")).alias("values"))
    )
    return report.join(samples, "variable", "left")


def code_like_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, code_like_pct, mean_length) over the distinct stripped values."""
    distinct = long_values(df, columns).where("value is not null").select("variable", strip(F.col("value")).alias("value")).distinct()
    return distinct.groupBy("variable").agg(
        F.round(F.avg(is_code_like(F.col("value")).cast("int")) * 100, 2).alias("code_like_pct"),
        F.round(F.avg(F.length("value")), 2).alias("mean_length"),
    ).orderBy(F.desc("code_like_pct"), "variable")


def missing_diagnostic(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, missing, missing_pct, distinct_values, min, median, mean, max); statistics for numeric columns only."""
    numeric = [c for c in columns if kind_of(df, c) == "numeric"]
    report = distinct_report(df, columns).select(
        "variable", "missing", percent(F.col("missing"), F.col("rows")).alias("missing_pct"), "distinct_values"
    )
    stats = wide_to_long(df, numeric, {
        "min": lambda c: F.min(name(c)).cast("double"),
        "mean": lambda c: F.avg(name(c)),
        "max": lambda c: F.max(name(c)).cast("double"),
    })
    medians = quantiles(df, {c: name(c) for c in numeric}, [0.5]).withColumnRenamed("q0", "median")
    return report.join(stats, "variable", "left").join(medians, "variable", "left")


def category_control(df: DataFrame, brand: str, categories: Sequence[str], top: int = 30) -> DataFrame:
    """(variable, item, n): the most frequent brands, then every value of the category columns."""
    brands = (
        df.where(name(brand).isNotNull()).groupBy(name(brand).alias("item")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "item").limit(top).select(F.lit(brand).alias("variable"), "item", "n")
    )
    values = value_counts(df, categories).where("value is not null").withColumnRenamed("value", "item")
    return brands.unionByName(values)


def numeric_text_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows whose text is digits only."""
    return df.where(is_digits(name(column)))


def dataset_report(parts: Mapping[str, tuple[DataFrame, str]], features: int) -> DataFrame:
    """(dataset, rows, variables, role) from name -> (rows, role)."""
    out = None
    for label, (rows, role) in parts.items():
        line = rows.agg(F.count("*").alias("rows")).select(
            F.lit(label).alias("dataset"), "rows", F.lit(features).cast("bigint").alias("variables"), F.lit(role).alias("role")
        )
        out = line if out is None else out.unionByName(line)
    return out


def part_report(df: DataFrame, part: str, roles: Mapping[str, str], variables: int) -> DataFrame:
    """(dataset, rows, variables, role) of the values of a part column, in one pass."""
    table = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])
    return df.groupBy(name(part).alias("dataset")).agg(F.count("*").alias("rows")).select(
        "dataset", "rows", F.lit(variables).cast("bigint").alias("variables"), F.element_at(table, F.col("dataset")).alias("role")
    )
