"""Canonical brand names: spelling variants, numeric brands resolved from the maker pair, aliases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetprep.cluster import stage
from fleetprep.functions.text import comparison_key, is_digits, name, strip, strip_upper
from fleetprep.operators.schema import require_columns
from fleetprep.operators.shape import text_columns


def normalize_text(df: DataFrame, upper_codes: Sequence[str] = (), rules: Mapping[str, str] | None = None) -> DataFrame:
    """Strip every text column, then change the case of code columns by rule; an unknown rule is an error."""
    rules = {**{c: "upper" for c in upper_codes}, **(rules or {})}
    unknown = sorted({r for r in rules.values()} - {"upper"})
    if unknown:
        raise ValueError("unknown normalisation rule: " + ", ".join(unknown))
    texts = text_columns(df)
    out = {c: strip(name(c)) for c in texts}
    for c in rules:
        if c in df.columns:
            out[c] = F.upper(out.get(c, name(c).cast("string")))
    return df.withColumns(out) if out else df


def make_counts(df: DataFrame, make: str, first: str, second: str) -> DataFrame:
    """(spelling, numeric, first, second, n): rows per stripped make and upper-case maker pair, computed once and staged.

    Everything that is learned about makes follows from this table; a brand held by many rows arrives as a few counts.
    """
    keys = [
        strip(name(make)).alias("spelling"), is_digits(name(make)).alias("numeric"),
        strip_upper(name(first)).alias(first), strip_upper(name(second)).alias(second),
    ]
    return stage(df.groupBy(*keys).agg(F.count("*").alias("n")))


def spelling_counts(counts: DataFrame) -> DataFrame:
    """(spelling, n, comparison_key) of the text makes."""
    text = counts.where("spelling is not null and not numeric").groupBy("spelling").agg(F.sum("n").alias("n"))
    return text.withColumn("comparison_key", comparison_key(F.col("spelling")))


def canonical_variants(spellings: DataFrame) -> DataFrame:
    """(comparison_key, canonical, observations, variants): the most frequent spelling of each key, ties to the smallest."""
    return spellings.groupBy("comparison_key").agg(
        F.min_by("spelling", F.struct(-F.col("n"), F.col("spelling"))).alias("canonical"),
        F.sum("n").alias("observations"),
        F.count("*").alias("variants"),
    )


def canonical_spellings(counts: DataFrame) -> DataFrame:
    """(spelling, canonical, comparison_key) for every spelling that occurs."""
    spellings = spelling_counts(counts)
    canon = canonical_variants(spellings).select("comparison_key", "canonical")
    return stage(spellings.join(canon, "comparison_key").select("spelling", "canonical", "comparison_key"))


def with_canonical(df: DataFrame, make: str, spellings: DataFrame) -> DataFrame:
    """Replace text makes by their canonical spelling; numeric and missing makes stay. A lookup, no pattern per row."""
    lookup = spellings.select(F.col("spelling").alias("_spelling"), F.col("canonical").alias("_canonical"))
    joined = df.withColumn("_spelling", strip(name(make))).join(lookup, "_spelling", "left")
    return joined.withColumn(make, F.coalesce("_canonical", name(make))).select(*[name(c) for c in df.columns])


def pair_share(counts: DataFrame, spellings: DataFrame, make: str, first: str, second: str) -> DataFrame:
    """(first, second, make, observations, pair_observations, share) of canonical text makes per upper-case maker pair."""
    text = counts.where(~F.col("numeric") & name(first).isNotNull() & name(second).isNotNull())
    text = text.join(spellings.select("spelling", F.col("canonical").alias(make)), "spelling")
    sums = text.groupBy(name(first), name(second), name(make)).agg(F.sum("n").alias("observations"))
    # one row per brand of a pair here
    total = F.sum("observations").over(Window.partitionBy(first, second))
    return sums.withColumn("pair_observations", total).withColumn("share", F.col("observations") / F.col("pair_observations"))


def reliable_pairs(shares: DataFrame, make: str, first: str, second: str, min_share: float) -> DataFrame:
    """The dominant make of each pair where it reaches the share; equal counts go to the smallest make."""
    if not 0 < min_share <= 1:
        raise ValueError("the minimal share must lie in ]0, 1]")
    order = F.struct(-F.col("observations"), name(make))
    best = shares.groupBy(first, second).agg(
        F.min_by(F.struct(name(make).alias("make"), "observations", "share"), order).alias("best")
    )
    return best.select(
        first, second, F.col("best.make").alias(make), F.col("best.observations").alias("observations"),
        F.col("best.share").alias("share"),
    ).where(F.col("share") >= min_share)


def resolve_numeric_make(df: DataFrame, make: str, first: str, second: str, pairs: DataFrame) -> DataFrame:
    """Numeric makes become the reliable make of their maker pair, or missing."""
    numeric = F.col("_numeric")
    keyed = df.withColumn("_numeric", is_digits(name(make))).withColumns({
        "_a": F.when(numeric, strip_upper(name(first))), "_b": F.when(numeric, strip_upper(name(second))),
    })
    lookup = pairs.select(name(first).alias("_a"), name(second).alias("_b"), name(make).alias("_make"))
    joined = keyed.join(lookup, ["_a", "_b"], "left")
    return joined.withColumn(make, F.when(numeric, F.col("_make")).otherwise(name(make))).select(*[name(c) for c in df.columns])


def normalize_make(df: DataFrame, make: str, first: str, second: str, min_share: float) -> tuple[DataFrame, DataFrame]:
    """The table with normalised makes, and a one-row report of what was done: one pass to count, one to look up.

    The lookups are staged, so their sizes are known and the engine joins them by broadcast or, beyond its threshold, by shuffle.
    """
    require_columns(df, [make, first, second])
    if not 0 < min_share <= 1:
        raise ValueError("the minimal share must lie in ]0, 1]")
    counts = make_counts(df, make, first, second)
    spellings = canonical_spellings(counts)
    pairs = stage(reliable_pairs(pair_share(counts, spellings, make, first, second), make, first, second, min_share))
    resolved = resolve_numeric_make(with_canonical(df, make, spellings), make, first, second, pairs)

    zero = F.lit(0).cast("bigint")
    looked_up = counts.where("numeric").join(pairs.select(first, second, F.lit(True).alias("found")), [first, second], "left")
    report = looked_up.agg(
        F.coalesce(F.sum("n"), zero).alias("numeric_before"), F.coalesce(F.sum(F.when(F.col("found"), F.col("n"))), zero).alias("numeric_resolved"),
        zero.alias("typographic_keys"), zero.alias("reliable_manufacturer_pairs"),
    )
    for rows, n in ((spellings, F.count_distinct("comparison_key")), (pairs, F.count("*"))):
        mine = "typographic_keys" if rows is spellings else "reliable_manufacturer_pairs"
        report = report.unionByName(rows.agg(*[(n if c == mine else zero).alias(c) for c in report.columns]))
    report = report.agg(*[F.sum(c).alias(c) for c in report.columns])
    return resolved, report.withColumn(
        "numeric_unresolved", F.col("numeric_before") - F.col("numeric_resolved")
    ).withColumn("resolution_threshold", F.lit(float(min_share)))


def apply_aliases(df: DataFrame, make: str, aliases: Mapping[str, str]) -> DataFrame:
    """Replace validated aliases by their brand, whatever their case and outer blanks."""
    if make not in df.columns:
        raise KeyError(f"missing column: {make}")
    key = strip_upper(name(make))
    out = F.when(F.lit(False), F.lit(""))
    for alias, brand in aliases.items():
        out = out.when(key == alias.strip().upper(), F.lit(brand))
    return df.withColumn(make, out.otherwise(name(make)))


def alias_counts(df: DataFrame, make: str, aliases: Mapping[str, str]) -> DataFrame:
    """(alias, brand, replaced) in one pass."""
    key = strip_upper(name(make))
    items = list(aliases.items())
    return df.agg(*[F.count_if(key == a.strip().upper()).alias(f"n{i}") for i, (a, _) in enumerate(items)]).select(
        F.inline(F.array(*[
            F.struct(F.lit(a).alias("alias"), F.lit(b).alias("brand"), F.col(f"n{i}").alias("replaced"))
            for i, (a, b) in enumerate(items)
        ]))
    )
