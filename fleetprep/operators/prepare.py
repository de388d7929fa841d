"""Imputation, indicators, one-hot columns and scaling: learned on training rows, applied as one projection."""

from __future__ import annotations

import json
import math
import os
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetprep import contracts as K
from fleetprep.cluster import one_row, stage
from fleetprep.functions.text import name
from fleetprep.functions.values import member, present
from fleetprep.operators.dictionary import dictionary, encode, load
from fleetprep.operators.quantiles import scalars
from fleetprep.operators.schema import require_columns
from fleetprep.operators.shape import missing_count, numeric_columns, value_counts, wide_to_long


MOST_CATEGORIES = 20_000  # one-hot columns in all, and values that reach the driver


@dataclass(frozen=True)
class Rules:
    """What to do with which column."""

    key: str = K.KEY
    target: str = K.TARGET
    part: str = K.PART
    categorical: Sequence[str] = tuple(K.CATEGORICAL_FEATURES)
    numeric: Sequence[str] = tuple(K.NUMERIC_FEATURES)
    group: str = K.FUEL
    conditional: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(K.CONDITIONAL_RULES))
    zero_fill: Sequence[str] = tuple(K.ZERO_FILL_COLUMNS)
    indicators: Mapping[str, str] = field(default_factory=lambda: dict(K.INDICATORS))
    excluded: Sequence[str] = tuple(K.MODEL_EXCLUDED)

    @property
    def medians(self) -> list[str]:
        return [c for c in self.numeric if c not in self.conditional and c not in self.zero_fill]


@dataclass(frozen=True)
class Params:
    """Everything learned on the training rows."""

    modes: dict[str, str]
    medians: dict[str, float]
    categories: dict[str, list[str]]
    means: dict[str, float]
    stds: dict[str, float]
    schema_version: int = 2
    wide: dict[str, str] = field(default_factory=dict)  # columns with too many values for one column each: where their dictionary lies
    sizes: dict[str, int] = field(default_factory=dict)  # and how many values it has

    def features(self, rules: Rules) -> list[str]:
        one_hot = [f"{c}_{v}" for c in rules.categorical if c in self.categories for v in self.categories[c]]
        return [*rules.numeric, *rules.indicators.values(), *one_hot, *[f"{c}_vector" for c in rules.categorical if c in self.wide]]

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> "Params":
        data = json.loads(text)
        if not isinstance(data, dict):
            raise ValueError("the root of a parameter file must be an object")
        return Params(**data)


# ---- learned values ----

def category_counts(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    return value_counts(train, columns).where("value is not null")


def train_modes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, mode, n): most frequent value of each column, ties to the smallest."""
    return category_counts(train, columns).groupBy("variable").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"), F.max("n").alias("n")
    )


def one_hot_categories(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value, n) of the categories seen in training."""
    return category_counts(train, columns)


def _modes_and_categories(rows, columns: Sequence[str]) -> tuple[dict[str, str], dict[str, list[str]]]:
    seen: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        seen[r.variable].append((-r.n, r.value))
    _require_values([c for c in columns if not seen[c]])
    return {c: min(v)[1] for c, v in seen.items()}, {c: sorted(x for _, x in v) for c, v in seen.items()}


def _require_values(empty: Sequence[str]) -> None:
    if empty:
        raise ValueError("no value to learn from in: " + ", ".join(empty))


def fit_categories(train: DataFrame, columns: Sequence[str], most: int = MOST_CATEGORIES) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Modes and sorted categories from one aggregation. Each category becomes a column of the table, so there may be `most` of them in
    all, which bounds what reaches the driver; with more, fit_any is the way."""
    rows = category_counts(train, columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} categories in: " + ", ".join(columns))
    return _modes_and_categories(rows, columns)


def fit_any(train: DataFrame, columns: Sequence[str], most: int = MOST_CATEGORIES) -> tuple[dict[str, str], dict[str, list[str]], dict[str, tuple[DataFrame, int]]]:
    """Modes, categories, and dictionaries of the columns whose values are too many to be columns: those with the fewest values get columns
    while there are `most` in all. The driver gets `most` values at most, and a mode and a number a column."""
    rows = category_counts(train, columns).limit(most + 1).collect()
    if len(rows) <= most:
        return *_modes_and_categories(rows, columns), {}
    counts = stage(category_counts(train, columns))
    found = {r["variable"]: r for r in counts.groupBy("variable").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"), F.count("*").alias("size")
    ).collect()}
    _require_values([c for c in columns if c not in found])
    narrow, used = [], 0
    for c in sorted(columns, key=lambda c: (found[c]["size"], c)):
        if used + found[c]["size"] <= most:
            narrow.append(c)
            used += found[c]["size"]
    _, categories = _modes_and_categories(counts.where(F.col("variable").isin(narrow)).collect(), narrow) if narrow else ({}, {})
    tables = {c: (dictionary(counts.where(F.col("variable") == c)), found[c]["size"]) for c in columns if c not in narrow}
    return {c: found[c]["mode"] for c in columns}, categories, tables


def median_inputs(rules: Rules) -> dict[str, Column]:
    """Values that count for the median of each column; categories must be filled already."""
    out = {c: F.when(member(name(rules.group), groups), name(c)) for c, groups in rules.conditional.items()}
    out.update({c: name(c) for c in rules.medians})
    return out


def fit_medians(train: DataFrame, rules: Rules, extra: Sequence[str] = ()) -> dict[str, float]:
    inputs = median_inputs(rules) | {c: name(c) for c in extra}
    medians = {c: v[0] for c, v in scalars(train, inputs, [0.5]).items()}
    bad = [c for c in inputs if medians.get(c) is None or not math.isfinite(medians[c])]
    if bad:
        raise ValueError("no finite median to learn from in: " + ", ".join(bad))
    return {c: medians[c] for c in inputs}


def scaler_params(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, mean, std), the population standard deviation."""
    return wide_to_long(train, columns, {"mean": lambda c: F.avg(name(c)), "std": lambda c: F.stddev_pop(name(c))})


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    rows = scaler_params(train, columns).collect()
    return {r.variable: r["mean"] for r in rows}, {r.variable: r["std"] or 1.0 for r in rows}


# ---- steps, each a projection ----

def impute_categorical(df: DataFrame, modes: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(name(c), F.lit(v)) for c, v in modes.items()})


def add_indicators(df: DataFrame, indicators: Mapping[str, str]) -> DataFrame:
    """1 where the original value is present; to be taken before numeric imputation."""
    return df.withColumns({flag: present(name(c)) for c, flag in indicators.items()})


def impute_conditional(df: DataFrame, rules: Rules, medians: Mapping[str, float]) -> DataFrame:
    """A missing value becomes 0 where the column does not apply to the group, and the training median where it does."""
    def fill(c: str, groups: Sequence[str]) -> Column:
        return F.coalesce(name(c), F.when(member(name(rules.group), groups), F.lit(medians[c])).otherwise(F.lit(0.0)))

    return df.withColumns({c: fill(c, groups) for c, groups in rules.conditional.items()})


def impute_numeric(df: DataFrame, rules: Rules, medians: Mapping[str, float]) -> DataFrame:
    """Conditional rules, then informative zeros, then medians for every other column that has one."""
    out = impute_conditional(df, rules, medians)
    fills = {c: F.coalesce(name(c), F.lit(0.0)) for c in rules.zero_fill}
    fills |= {c: F.coalesce(name(c), F.lit(medians[c])) for c in medians if c not in rules.conditional and c in df.columns}
    return out.withColumns(fills)


def require_complete(df: DataFrame, columns: Sequence[str]) -> None:
    left = one_row(df, {c: missing_count(c) for c in columns})
    bad = sorted(c for c, n in left.items() if n)
    if bad:
        raise ValueError("missing values are left in: " + ", ".join(bad))


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column per training category, named column_value; an unknown value gives zeros. Source columns go."""
    encoded = [
        F.coalesce(name(c) == F.lit(v), F.lit(False)).cast("byte").alias(f"{c}_{v}")
        for c, values in categories.items() for v in values
    ]
    return df.select(*[name(c) for c in df.columns if c not in categories], *encoded)


def fit_wide(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Sparse one-hot vectors for columns with any number of values: one vector column per text column, not one column per value."""
    indexed, encoded = [f"{c}_index" for c in columns], [f"{c}_vector" for c in columns]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True),
    ]).fit(train)


def encode_wide(df: DataFrame, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Replace text columns by their vectors; unknown and missing values share one place of their own."""
    return model.transform(df).drop(*columns, *[f"{c}_index" for c in columns])


def standardize(df: DataFrame, means: Mapping[str, float], stds: Mapping[str, float]) -> DataFrame:
    """(x - mean) / std; a std of 0 divides by 1."""
    return df.withColumns({c: (name(c) - F.lit(means[c])) / F.lit(stds[c] or 1.0) for c in means})


# ---- the whole preparation ----

def fit(df: DataFrame, rules: Rules = Rules(), most: int = MOST_CATEGORIES) -> Params:
    """Learn all parameters from the training rows: three aggregations over the needed columns. Categories beyond `most` become
    dictionaries in the shared folder, which the parameters name."""
    require_columns(df, [rules.part, *rules.categorical, *rules.numeric])
    train = df.where(name(rules.part) == "train")
    modes, categories, tables = fit_any(train, rules.categorical, most)
    filled = impute_categorical(train, modes)
    medians = fit_medians(filled, rules, _uncovered(df, rules))
    means, stds = fit_scaler(impute_numeric(filled, rules, medians), list(rules.numeric))
    wide = {c: os.path.dirname(table.inputFiles()[0]) for c, (table, _) in tables.items()}
    return Params(modes, medians, categories, means, stds, wide=wide, sizes={c: n for c, (_, n) in tables.items()})


def _uncovered(df: DataFrame, rules: Rules) -> list[str]:
    """Numeric columns no rule covers that still have missing values."""
    known = {rules.key, rules.target, rules.part, *rules.numeric, *rules.excluded, *rules.indicators.values()}
    others = [c for c in numeric_columns(df) if c not in known]
    if not others:
        return []
    left = one_row(df, {c: missing_count(c) for c in others})
    return [c for c in others if left[c]]


def imputed(df: DataFrame, params: Params, rules: Rules = Rules()) -> DataFrame:
    """Categories filled, indicators taken, numbers filled."""
    return impute_numeric(add_indicators(impute_categorical(df, params.modes), rules.indicators), rules, params.medians)


def transform(df: DataFrame, params: Params, rules: Rules = Rules()) -> DataFrame:
    """Key, target and part if present, then the features in their fixed order. Works on a stream as well."""
    ready = one_hot(standardize(imputed(df, params, rules), params.means, params.stds), params.categories)
    ready = encode(ready, load(df.sparkSession, params.wide, params.sizes))
    front = [c for c in (rules.key, rules.target, rules.part) if c in df.columns]
    return ready.select(*[name(c) for c in front], *[name(c) for c in params.features(rules)])


# ---- reports ----

def imputation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """(variable, part, nature, n): structural and residual gaps of the rule columns, gaps of the others.

    Expects filled categories. One pass: every count is an aggregate of the same group-by on the part.
    """
    group = name(rules.group)
    cells = []
    for c, groups in rules.conditional.items():
        applies, gap = member(group, groups), name(c).isNull()
        cells += [(c, "structural", F.count_if(gap & ~applies)), (c, "residual", F.count_if(gap & applies))]
    cells += [(c, "informative", missing_count(c)) for c in rules.zero_fill]
    cells += [(c, "rare", missing_count(c)) for c in rules.medians]
    counted = df.groupBy(name(rules.part).alias("part")).agg(*[agg.alias(f"n{i}") for i, (_, _, agg) in enumerate(cells)])
    return counted.select("part", F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.lit(nature).alias("nature"), F.col(f"n{i}").alias("n"))
        for i, (c, nature, _) in enumerate(cells)
    ])))


def conditional_report(df: DataFrame, rules: Rules, medians: Mapping[str, float]) -> DataFrame:
    """(variable, median_train, train_structural, train_residual, test_structural, test_residual)."""
    counts = imputation_counts(df, rules).where(F.col("nature").isin("structural", "residual"))
    cell = lambda p, nature: F.coalesce(
        F.sum(F.when((F.col("part") == p) & (F.col("nature") == nature), F.col("n"))), F.lit(0)
    ).alias(f"{p}_{nature}")
    wide = counts.groupBy("variable").agg(*[cell(p, nature) for p in ("train", "test") for nature in ("structural", "residual")])
    table = F.create_map(*[x for c in rules.conditional for x in (F.lit(c), F.lit(float(medians[c])))])
    return wide.withColumn("median_train", F.element_at(table, F.col("variable")))


def imputation_summary(df: DataFrame, rules: Rules, medians: Mapping[str, float]) -> DataFrame:
    """(position, variable, part, nature, n, treatment, value, origin) of the gaps that occur, in a fixed order."""
    order = [*rules.conditional, *rules.zero_fill, *rules.medians]
    place = F.create_map(*[x for i, c in enumerate(order) for x in (F.lit(c), F.lit(i))])
    values = F.create_map(*[x for c, v in medians.items() for x in (F.lit(c), F.lit(float(v)))])
    by_median = F.col("nature").isin("residual", "rare")
    return (
        imputation_counts(df, rules).where("n > 0")
        .withColumn("treatment", F.when(by_median, "median").otherwise("zero"))
        .withColumn("value", F.when(by_median, F.try_element_at(values, F.col("variable"))).otherwise(F.lit(0.0)))
        .withColumn("origin", F.when(by_median, "train median").otherwise("business rule"))
        .withColumn("position", F.element_at(place, F.col("variable")))
        .orderBy("position", F.when(F.col("part") == "train", 0).otherwise(1), "nature")
    )


def params_table(spark, params: Params, rules: Rules = Rules()) -> DataFrame:
    """(kind, position, variable, text, number): all learned values in long form."""
    rows = [("mode", i, c, v, None) for i, (c, v) in enumerate(params.modes.items())]
    rows += [("median", i, c, None, float(v)) for i, (c, v) in enumerate(params.medians.items())]
    for c, values in params.categories.items():
        rows += [("category", i, c, v, None) for i, v in enumerate(values)]
    rows += [("dictionary", i, c, path, float(params.sizes[c])) for i, (c, path) in enumerate(params.wide.items())]
    rows += [("mean", i, c, None, float(v)) for i, (c, v) in enumerate(params.means.items())]
    rows += [("std", i, c, None, float(v)) for i, (c, v) in enumerate(params.stds.items())]
    rows += [("indicator", i, c, v, None) for i, (c, v) in enumerate(rules.indicators.items())]
    rows += [("feature", i, c, None, None) for i, c in enumerate(params.features(rules))]
    return spark.createDataFrame(rows, "kind string, position int, variable string, text string, number double")


def unseen_categories(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """(variable, value, n): test values that no training row has."""
    test = category_counts(df.where(name(part) == "test"), columns)
    train = category_counts(df.where(name(part) == "train"), columns)
    return test.join(train.select("variable", "value"), ["variable", "value"], "left_anti")
