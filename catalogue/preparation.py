"""Splits, folds, imputation, encoding, scaling and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import blocks as B
from catalogue.blocks import HASH, q, quoted, sql
from catalogue.inputs import cleaned_rows, feature_rows, labelled, normalized, split_rows
from catalogue.registry import n, query, r
from fleetprep import contracts as K
from fleetprep.cluster import stage
from fleetprep.functions.text import name
from fleetprep.operators import checks as Q
from fleetprep.operators import prepare as P
from fleetprep.operators import split as S
from fleetprep.operators.discretize import emission_class
from fleetprep.plans import features
from fleetprep.plans.preprocessing import RULES, matrix_checks, prepare

KEY = K.KEY
FLAGS = list(K.INDICATORS.values())
ONE_HOT = [f"{c}_{v}" for c, values in B.CATEGORIES.items() for v in values]
FEATURES = [*K.NUMERIC_FEATURES, *FLAGS, *ONE_HOT]
Y = "co2_wltp_g_km"


def _one_hot_sql() -> str:
    return ", ".join(
        f"{n(f'CASE WHEN {c} = ' + quoted([v]) + ' THEN 1 ELSE 0 END')} AS {q(f'{c}_{v}')}" for c, values in B.CATEGORIES.items() for v in values
    )


def _numbers(columns) -> str:
    return ", ".join(f"{r(c)} AS {c}" for c in columns)


# ---- splits, samples, folds ----

@query("train_test_split", sql(f"SELECT vehicle_record_id, part, {r(Y)} AS {Y} FROM split", "split"))
def _(spark, sf):
    return split_rows(spark, sf).select(KEY, K.PART, K.TARGET)


@query("dev_sample", sql(
    f"WITH sampled AS (SELECT * FROM features ORDER BY {HASH.format(seed='42|sample')}, vehicle_record_id LIMIT (SELECT count(*) // 2 FROM features)) "
    + B.split_sql("sampled", "42|validation", "validation", "train", "vehicle_record_id"), "features",
))
def _(spark, sf):
    rows = stage(feature_rows(spark, sf))
    return S.development_sample(rows, KEY, rows.count() // 2, K.TEST_SHARE, K.SEED, K.PART).select(KEY, K.PART)


@query("stratified_sample", sql(
    "WITH labelled_class AS (SELECT vehicle_record_id, " + B.emission_class(Y) + " AS co2_emission_class FROM labelled), "
    "sizes AS (SELECT co2_emission_class AS c, count(*) AS k FROM labelled_class GROUP BY 1), "
    "total AS (SELECT sum(k) AS n, sum(k) // 3 AS m FROM sizes), "
    "shares AS (SELECT c, (k * m) // n AS whole, (k * m) % n AS rest, m FROM sizes, total), "
    "alloc AS (SELECT c, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= m - sum(whole) OVER () THEN 1 ELSE 0 END AS take FROM shares) "
    f"SELECT z.vehicle_record_id, z.co2_emission_class FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY co2_emission_class ORDER BY {HASH.format(seed='42')}, vehicle_record_id) AS rn FROM labelled_class) z "
    "JOIN alloc a ON a.c = z.co2_emission_class WHERE z.rn <= a.take", "labelled",
))
def _(spark, sf):
    rows = stage(emission_class(labelled(spark, sf), K.TARGET, K.CLASS_BOUNDS, K.CLASS_LABELS, K.CLASS).select(KEY, K.CLASS))
    return S.stratified_sample(rows, KEY, K.CLASS, rows.count() // 3, K.SEED)


@query("stratified_split", sql(
    "WITH labelled_class AS (SELECT vehicle_record_id, " + B.emission_class(Y) + " AS co2_emission_class FROM labelled), "
    "sizes AS (SELECT co2_emission_class AS c, count(*) AS k FROM labelled_class GROUP BY 1), "
    "total AS (SELECT sum(k) AS n, (sum(k) + 4) // 5 AS m FROM sizes), "
    "shares AS (SELECT c, (k * m) // n AS whole, (k * m) % n AS rest, m FROM sizes, total), "
    "alloc AS (SELECT c, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= m - sum(whole) OVER () THEN 1 ELSE 0 END AS take FROM shares) "
    f"SELECT z.vehicle_record_id, z.co2_emission_class, CASE WHEN z.rn <= a.take THEN 'test' ELSE 'train' END AS part FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY co2_emission_class ORDER BY {HASH.format(seed='42')}, vehicle_record_id) AS rn FROM labelled_class) z "
    "JOIN alloc a ON a.c = z.co2_emission_class", "labelled",
))
def _(spark, sf):
    rows = emission_class(labelled(spark, sf).select(KEY, K.TARGET), K.TARGET, K.CLASS_BOUNDS, K.CLASS_LABELS, K.CLASS)
    return S.stratified_split(rows, KEY, K.CLASS, K.TEST_SHARE, K.SEED, K.PART).select(KEY, K.CLASS, K.PART)


@query("k_folds", sql("SELECT vehicle_record_id, ntile(3) OVER (ORDER BY vehicle_record_id) - 1 AS fold FROM labelled", "labelled"))
def _(spark, sf):
    return S.k_folds(labelled(spark, sf).select(KEY), KEY, K.REGRESSION_FOLDS)


@query("stratified_folds", sql(
    f"SELECT vehicle_record_id, co2_emission_class, ntile(3) OVER (PARTITION BY co2_emission_class ORDER BY {HASH.format(seed='42')}, vehicle_record_id) - 1 AS fold FROM "
    f"(SELECT vehicle_record_id, {B.emission_class(Y)} AS co2_emission_class FROM labelled) z", "labelled",
))
def _(spark, sf):
    rows = emission_class(labelled(spark, sf).select(KEY, K.TARGET), K.TARGET, K.CLASS_BOUNDS, K.CLASS_LABELS, K.CLASS).drop(K.TARGET)
    return S.stratified_folds(rows, KEY, K.CLASS, K.CLASSIFICATION_FOLDS, K.SEED)


_seen = ["commercial_name", "vehicle_variant", "fuel_type"]


_unseen = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS value, count(*) AS n FROM wide_split WHERE part = 'test' AND {c} IS NOT NULL AND {c} NOT IN "
    f"(SELECT {c} FROM wide_split WHERE part = 'train' AND {c} IS NOT NULL) GROUP BY {c}" for c in _seen
)


@query("unseen_categories", sql(
    f"WITH wide_split AS (SELECT x.*, s.part FROM norm x JOIN split s USING (vehicle_record_id)) {_unseen}", "norm", "split"
))
def _(spark, sf):
    rows = normalized(spark, sf).where(name(K.TARGET).isNotNull()).select(KEY, *_seen)
    return P.unseen_categories(S.train_test_split(rows, KEY, K.TEST_SHARE, K.SEED, K.PART), K.PART, _seen)


# ---- learned values ----

def _train(spark, sf):
    return split_rows(spark, sf).where(name(K.PART) == "train")


@query("train_modes", sql(" UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS variable, {c} AS mode, count(*) AS n FROM split WHERE part = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, mode LIMIT 1) {c}_z"
    for c in K.CATEGORICAL_FEATURES
), "split"))
def _(spark, sf):
    return P.train_modes(_train(spark, sf), K.CATEGORICAL_FEATURES)


def _filled(spark, sf):
    """Split rows with filled categories, and the modes."""
    split = split_rows(spark, sf)
    modes, _categories = P.fit_categories(split.where(name(K.PART) == "train"), K.CATEGORICAL_FEATURES)
    return P.impute_categorical(split, modes), modes


@query("train_medians", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {r(B._median(c))} AS median" for c in [*K.CONDITIONAL_RULES, *RULES.medians]
), "train_filled"))
def _(spark, sf):
    from fleetprep.operators.quantiles import quantiles

    filled, _modes = _filled(spark, sf)
    return quantiles(filled.where(name(K.PART) == "train"), P.median_inputs(RULES), [0.5]).withColumnRenamed("q0", "median")


@query("impute_categorical", sql(f"SELECT vehicle_record_id, part, {', '.join(K.CATEGORICAL_FEATURES)} FROM filled", "filled"))
def _(spark, sf):
    return _filled(spark, sf)[0].select(KEY, K.PART, *K.CATEGORICAL_FEATURES)


def _imputed(spark, sf):
    """Split rows fully imputed, with flags, and the medians; the filled rows too."""
    filled, _modes = _filled(spark, sf)
    medians = P.fit_medians(filled.where(name(K.PART) == "train"), RULES)
    return P.impute_numeric(P.add_indicators(filled, K.INDICATORS), RULES, medians), medians, filled


@query("impute_conditional", sql(f"SELECT vehicle_record_id, part, {_numbers(K.CONDITIONAL_RULES)} FROM imputed", "imputed"))
def _(spark, sf):
    filled, _modes = _filled(spark, sf)
    medians = P.fit_medians(filled.where(name(K.PART) == "train"), RULES)
    return P.impute_conditional(filled, RULES, medians).select(KEY, K.PART, *K.CONDITIONAL_RULES)


def _gap(c: str, part: str, kind: str) -> str:
    test = f"fuel_type IN ({quoted(K.CONDITIONAL_RULES[c])})"
    return f"count(*) FILTER (WHERE part = '{part}' AND {c} IS NULL AND {'NOT ' if kind == 'structural' else ''}{test})"


_parts = [(p, k) for p in ("train", "test") for k in ("structural", "residual")]


@query("impute_conditional_report", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {r(B._median(c))} AS median_train, " + ", ".join(f"{_gap(c, p, k)} AS {p}_{k}" for p, k in _parts) + " FROM filled"
    for c in K.CONDITIONAL_RULES
), "filled", "train_filled"))
def _(spark, sf):
    _rows, medians, filled = _imputed(spark, sf)
    return P.conditional_report(filled, RULES, medians)


@query("impute_numeric", sql(f"SELECT vehicle_record_id, part, {_numbers(K.NUMERIC_FEATURES)} FROM imputed", "imputed"))
def _(spark, sf):
    return _imputed(spark, sf)[0].select(KEY, K.PART, *K.NUMERIC_FEATURES)


def _summary_sql() -> str:
    lines, order = [], [*K.CONDITIONAL_RULES, *K.ZERO_FILL_COLUMNS, *RULES.medians]
    for i, c in enumerate(order):
        for part in ("train", "test"):
            gaps = f"count(*) FILTER (WHERE part = '{part}' AND {c} IS NULL)"
            kinds = (
                [("structural", _gap(c, part, "structural")), ("residual", _gap(c, part, "residual"))] if c in K.CONDITIONAL_RULES
                else [("informative", gaps)] if c in K.ZERO_FILL_COLUMNS else [("rare", gaps)]
            )
            for kind, count in kinds:
                learned = kind in ("residual", "rare")
                lines.append(
                    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS variable, '{part}' AS part, '{kind}' AS nature, {count} AS n, "
                    f"'{'median' if learned else 'zero'}' AS treatment, {r(B._median(c) if learned else '0')} AS value, "
                    f"'{'train median' if learned else 'business rule'}' AS origin FROM filled"
                )
    return f"SELECT * FROM ({' UNION ALL '.join(lines)}) z WHERE n > 0"


@query("imputation_summary", sql(_summary_sql(), "filled", "train_filled"))
def _(spark, sf):
    _rows, medians, filled = _imputed(spark, sf)
    return P.imputation_summary(filled, RULES, medians)


@query("one_hot", sql(f"SELECT vehicle_record_id, part, {_one_hot_sql()} FROM filled", "filled"))
def _(spark, sf):
    split = split_rows(spark, sf).select(KEY, K.PART, *K.CATEGORICAL_FEATURES)
    modes, categories = P.fit_categories(split.where(name(K.PART) == "train"), K.CATEGORICAL_FEATURES)
    return P.one_hot(P.impute_categorical(split, modes), categories)


@query("one_hot_categories", sql(B.per_column(
    K.CATEGORICAL_FEATURES, "SELECT {v} AS variable, {c} AS value, count(*) AS n FROM split WHERE part = 'train' AND {c} IS NOT NULL GROUP BY {c}"
), "split"))
def _(spark, sf):
    return P.one_hot_categories(_train(spark, sf), K.CATEGORICAL_FEATURES)


@query("scaler_params", sql(B.per_column(
    K.NUMERIC_FEATURES, f"SELECT {{v}} AS variable, {r('avg({c})')} AS mean, {r('stddev_pop({c})')} AS std FROM train_imputed"
), "train_imputed"))
def _(spark, sf):
    rows, _medians, _filled_rows = _imputed(spark, sf)
    return P.scaler_params(rows.where(name(K.PART) == "train"), K.NUMERIC_FEATURES)


@query("standardize", sql(f"SELECT vehicle_record_id, part, {_numbers(K.NUMERIC_FEATURES)} FROM scaled", "scaled"))
def _(spark, sf):
    rows, _medians, _filled_rows = _imputed(spark, sf)
    means, stds = P.fit_scaler(rows.where(name(K.PART) == "train"), K.NUMERIC_FEATURES)
    return P.standardize(rows, means, stds).select(KEY, K.PART, *K.NUMERIC_FEATURES)


# ---- the whole preparation ----

_prepared = (
    f"SELECT vehicle_record_id, {r(Y)} AS {Y}, part, {_numbers(K.NUMERIC_FEATURES)}, " + ", ".join(f"{n(f)} AS {f}" for f in FLAGS)
    + f", {_one_hot_sql()} FROM scaled"
)


@query("preprocessed", sql(_prepared, "scaled"))
def _(spark, sf):
    table = features.build(stage(cleaned_rows(spark, sf)))
    return prepare(stage(table)).rows


@query("apply_params", sql(_prepared, "scaled"))
def _(spark, sf):
    """Parameters that went through their saved form, applied to the rows as a projection."""
    split = split_rows(spark, sf)
    return P.transform(split, P.Params.from_json(P.fit(split, RULES).to_json()), RULES)


def _params_sql() -> str:
    lines = []

    def line(kind, position, variable, text="NULL", number="NULL"):
        lines.append(
            f"SELECT '{kind}' AS kind, CAST({position} AS BIGINT) AS position, '{variable}' AS variable, CAST({text} AS VARCHAR) AS text, {r(number)} AS number"
        )

    for i, c in enumerate(K.CATEGORICAL_FEATURES):
        line("mode", i, c, text=B._mode.format(c=c))
        lines.append(
            f"SELECT 'category', row_number() OVER (ORDER BY {c}) - 1, '{c}', {c}, CAST(NULL AS DOUBLE) FROM (SELECT DISTINCT {c} FROM split WHERE part = 'train' AND {c} IS NOT NULL) {c}_z"
        )
    for i, c in enumerate([*K.CONDITIONAL_RULES, *RULES.medians]):
        line("median", i, c, number=B._median(c))
    for i, c in enumerate(K.NUMERIC_FEATURES):
        line("mean", i, c, number=f"(SELECT avg({c}) FROM train_imputed)")
        line("std", i, c, number=f"(SELECT stddev_pop({c}) FROM train_imputed)")
    for i, (c, f) in enumerate(K.INDICATORS.items()):
        line("indicator", i, c, text=f"'{f}'")
    for i, c in enumerate(FEATURES):
        line("feature", i, c)
    return " UNION ALL ".join(lines)


@query("fitted_params", sql(_params_sql(), "split", "train_filled", "train_imputed"))
def _(spark, sf):
    return P.params_table(spark, P.fit(split_rows(spark, sf), RULES), RULES)


# ---- checks ----

def _matrix(spark, sf):
    split = split_rows(spark, sf)
    params = P.fit(split, RULES)
    return stage(P.transform(split, params, RULES)), params


_missing = " OR ".join(f"{c} IS NULL" for c in K.NUMERIC_FEATURES)
_infinite = " OR ".join(f"isinf({c})" for c in K.NUMERIC_FEATURES)
_binary = " OR ".join(f"{f} NOT IN (0, 1)" for f in FLAGS)


def _checks_sql(tests: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS \"check\", {v} AND count(*) > 0 AS ok FROM scaled" for k, v in tests.items())


def _per_part(label: str, test: str) -> dict[str, str]:
    return {f"{label}:{p}": test.format(p=f"part = '{p}'") for p in ("train", "test")}


@query("quality_checks_matrix", sql(_checks_sql({
    **_per_part("no_missing", f"count(*) FILTER (WHERE {{p}} AND ({_missing})) = 0"),
    **_per_part("no_infinite", f"count(*) FILTER (WHERE {{p}} AND ({_infinite})) = 0"),
    **_per_part("rows_match", f"count(*) FILTER (WHERE {{p}}) = count({Y}) FILTER (WHERE {{p}})"),
    "same_columns": "true", "all_numeric": "true", "originals_absent": "true", "excluded_absent": "true",
    "indicators_binary": f"count(*) FILTER (WHERE {_binary}) = 0",
}), "scaled"))
def _(spark, sf):
    matrix, params = _matrix(spark, sf)
    return matrix_checks(matrix, params)


_common = {
    "same_columns": "true",
    **_per_part("rows_match", f"count(*) FILTER (WHERE {{p}}) = count({Y}) FILTER (WHERE {{p}})"),
    **_per_part("no_missing_x", f"count(*) FILTER (WHERE {{p}} AND ({_missing})) = 0"),
    **_per_part("no_missing_y", f"count(*) FILTER (WHERE {{p}} AND {Y} IS NULL) = 0"),
}
_regression = {**_common, **_per_part("target_absent", "true"), **_per_part("all_numeric", "true"), "excluded_absent": "true"}
_classification = {**_common, **_per_part("no_infinite", f"count(*) FILTER (WHERE {{p}} AND ({_infinite})) = 0")}


@query("quality_checks_training", sql(
    f"SELECT 'regression' AS task, * FROM ({_checks_sql(_regression)}) a UNION ALL SELECT 'classification', * FROM ({_checks_sql(_classification)}) b", "scaled"
))
def _(spark, sf):
    matrix, params = _matrix(spark, sf)
    tables = [
        Q.training_checks(matrix, K.PART, params.features(RULES), K.TARGET, K.MODEL_EXCLUDED, infinite).select(F.lit(task).alias("task"), "*")
        for task, infinite in (("regression", False), ("classification", True))
    ]
    return tables[0].unionByName(tables[1])


_treated = [*K.CONDITIONAL_RULES, *K.ZERO_FILL_COLUMNS, *RULES.medians, *FLAGS]


@query("treatment_status", sql(" UNION ALL ".join(
    f"SELECT '{stage_name}' AS stage, '{c}' AS variable, count(*) FILTER (WHERE part = 'train' AND {c} IS NULL) AS missing_train, "
    f"count(*) FILTER (WHERE part = 'test' AND {c} IS NULL) AS missing_test, CASE WHEN count({c}) = count(*) THEN 'OK' ELSE 'to check' END AS status FROM {source}"
    for stage_name, source in (("before", "flagged"), ("after", "imputed")) for c in _treated
), "flagged", "imputed"))
def _(spark, sf):
    after, _medians, filled = _imputed(spark, sf)
    before = P.add_indicators(filled, K.INDICATORS)
    return Q.treatment_status(before, K.PART, _treated).select(F.lit("before").alias("stage"), "*").unionByName(
        Q.treatment_status(after, K.PART, _treated).select(F.lit("after").alias("stage"), "*")
    )


@query("indicator_consistency", sql(" UNION ALL ".join(
    f"SELECT part, '{c}' AS variable, count(*) FILTER (WHERE {f} = 0) AS indicator_zeros, count(*) - count({c}) AS missing, "
    f"count(*) FILTER (WHERE {f} = 0) = count(*) - count({c}) AS ok FROM flagged GROUP BY part" for c, f in K.INDICATORS.items()
), "flagged"))
def _(spark, sf):
    filled, _modes = _filled(spark, sf)
    return Q.indicator_consistency(P.add_indicators(filled, K.INDICATORS), K.PART, K.INDICATORS)


_all_gaps = [*K.CATEGORICAL_FEATURES, *K.NUMERIC_FEATURES]


@query("remaining_missing", sql(
    "SELECT * FROM (" + B.per_column(_all_gaps, "SELECT {v} AS variable, count(*) - count({c}) AS missing FROM features")
    + ") z WHERE missing > 0 UNION ALL SELECT '(all)', " + " + ".join(f"count(*) - count({c})" for c in _all_gaps) + " FROM features", "features",
))
def _(spark, sf):
    return Q.remaining_missing(feature_rows(spark, sf), _all_gaps)
