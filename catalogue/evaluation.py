"""Measures, comparisons and choices on stand-in predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.blocks import sql
from catalogue.inputs import model_predictions, predictions
from catalogue.registry import n, pct, query, r
from fleetprep import contracts as K
from fleetprep.functions.text import name
from fleetprep.operators import metrics as M
from fleetprep.operators import ranking
from fleetprep.operators.split import k_folds

LABELS = K.CLASS_LABELS


def class_sql(source: str, by: str = "") -> str:
    """Blocks cm_sides, cm_report over (by, class_true, class_pred) rows."""
    keys = f"{by}, " if by else ""
    return (
        f"counts AS (SELECT {keys}class_true AS t, class_pred AS p, count(*) AS k FROM {source} GROUP BY ALL), "
        f"sides AS (SELECT {keys}t AS label, k AS support, 0 AS claimed, CASE WHEN t = p THEN k ELSE 0 END AS hits FROM counts "
        f"UNION ALL SELECT {keys}p, 0, k, 0 FROM counts), "
        f"report AS (SELECT {keys}label, CAST(sum(support) AS BIGINT) AS support, CAST(sum(hits) AS BIGINT) AS hits, coalesce(sum(hits) / nullif(sum(claimed), 0), 0) AS precision, "
        f"coalesce(sum(hits) / nullif(sum(support), 0), 0) AS recall, coalesce(2.0 * sum(hits) / nullif(sum(support) + sum(claimed), 0), 0) AS f1 FROM sides GROUP BY ALL)"
    )


SCORES = (
    f"{n('sum(support)')} AS rows, {r('sum(hits) / sum(support)')} AS accuracy, {r('avg(recall) FILTER (WHERE support > 0)')} AS balanced_accuracy, "
    f"{r('avg(f1)')} AS macro_f1, {r('sum(f1 * support) / sum(support)')} AS weighted_f1"
)


@query("regression_metrics", sql(
    f"SELECT count(*) AS rows, {r('avg(abs(y_true - y_pred))')} AS mae, {r('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))')} AS rmse, "
    f"{r('1 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*))')} AS r2 FROM predictions", "predictions",
))
def _(spark, sf):
    return M.regression_metrics(predictions(spark, sf), "y_true", "y_pred")


@query("classification_metrics", sql(f"WITH {class_sql('predictions')} SELECT {SCORES} FROM report", "predictions"))
def _(spark, sf):
    return M.evaluate_classes(predictions(spark, sf), "class_true", "class_pred")


@query("class_report", sql(
    f"WITH {class_sql('predictions')} SELECT v.label, {r('coalesce(precision, 0)')} AS precision, {r('coalesce(recall, 0)')} AS recall, {r('coalesce(f1, 0)')} AS f1, "
    f"{n('coalesce(support, 0)')} AS support, {n('coalesce(hits, 0)')} AS hits FROM (SELECT unnest({[*LABELS, 'none']}) AS label) v LEFT JOIN report USING (label)", "predictions",
))
def _(spark, sf):
    counts = M.confusion_counts(predictions(spark, sf), "class_true", "class_pred")
    return M.class_report(counts, [*LABELS, "none"])  # one label of the set never occurs


def _cell(v: str) -> str:
    return f"count(*) FILTER (WHERE x.class_pred = '{v}')"


def _matrix_sql(cells: str) -> str:
    values = ", ".join(f"('{v}')" for v in LABELS)
    return f"SELECT l.truth, {cells} FROM (VALUES {values}) l(truth) LEFT JOIN predictions x ON x.class_true = l.truth GROUP BY l.truth"


@query("confusion_matrix", sql(_matrix_sql(", ".join(f"{_cell(v)} AS \"{v}\"" for v in LABELS)), "predictions"))
def _(spark, sf):
    return M.confusion_matrix(M.confusion_counts(predictions(spark, sf), "class_true", "class_pred"), LABELS)


@query("confusion_matrix_normalized", sql(
    _matrix_sql(", ".join(f"{r(pct(_cell(v), 'count(x.class_pred)'))} AS \"{v}\"" for v in LABELS)), "predictions"
))
def _(spark, sf):
    return M.confusion_matrix(M.confusion_counts(predictions(spark, sf), "class_true", "class_pred"), LABELS, normalized=True)


def _comparison(spark, sf):
    rows = model_predictions(spark, sf)
    measures = M.regression_metrics(rows, "y_true", "y_pred", ["model", K.PART, "training_seconds"])
    table = M.with_gaps(measures, ["mae", "rmse"], ["r2"])
    seconds = measures.groupBy("model").agg(F.max("training_seconds").alias("training_seconds"))
    return table.join(seconds, "model").orderBy("rmse_validation")


_comparison_columns = [f"{m}_{s}" for m in ("mae", "rmse", "r2") for s in ("train", "validation", "gap")]


@query("model_comparison", sql(
    "SELECT model, " + ", ".join(f"{r(c)} AS {c}" for c in [*_comparison_columns, "training_seconds"]) + " FROM regression_comparison", "regression_comparison"
))
def _(spark, sf):
    return _comparison(spark, sf)


_scores = ["accuracy", "balanced_accuracy", "macro_f1", "weighted_f1"]
_raw_scores = (
    "sum(hits) / sum(support) AS accuracy, avg(recall) FILTER (WHERE support > 0) AS balanced_accuracy, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1"
)


@query("model_comparison_classes", sql(
    f"WITH {class_sql('model_predictions', 'model, part')}, m AS (SELECT model, part, {_raw_scores} FROM report GROUP BY ALL) SELECT t.model, "
    + ", ".join(f"{r('t.' + s)} AS {s}_train, {r('v.' + s)} AS {s}_validation, {r(f't.{s} - v.{s}')} AS {s}_gap" for s in _scores)
    + " FROM m t JOIN m v ON v.model = t.model AND t.part = 'train' AND v.part = 'validation'", "model_predictions",
))
def _(spark, sf):
    measures = M.evaluate_classes(model_predictions(spark, sf), "class_true", "class_pred", ["model", K.PART])
    return M.with_gaps(measures, [], _scores)


_picks = {
    "best_mae": "mae_validation", "best_rmse": "rmse_validation", "best_r2": "-r2_validation", "fastest": "training_seconds", "most_stable": "abs(rmse_gap)",
}


@query("best_models", sql(" UNION ALL ".join(
    f"SELECT * FROM (SELECT '{k}' AS criterion, model, {r(v.lstrip('-'))} AS value FROM regression_comparison ORDER BY round({v}, 12), model LIMIT 1) {k}_z" for k, v in _picks.items()
), "regression_comparison"))
def _(spark, sf):
    return ranking.best_models(_comparison(spark, sf))


_class_seconds = "(SELECT model, max(training_seconds) AS s FROM model_predictions GROUP BY model)"
_class_picks = {
    "best_macro_f1": ("-f_v", "f_v"), "fastest": ("s", "s"), "most_stable": ("abs(f_t - f_v)", "abs(f_t - f_v)"),
}


@query("best_models_classes", sql(
    f"WITH {class_sql('model_predictions', 'model, part')}, c AS (SELECT r.model, avg(f1) FILTER (WHERE part = 'validation') AS f_v, "
    f"avg(f1) FILTER (WHERE part = 'train') AS f_t, max(t.s) AS s FROM report r JOIN {_class_seconds} t ON t.model = r.model GROUP BY r.model) "
    + " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{k}' AS criterion, model, {r(v)} AS value FROM c ORDER BY round({o}, 12), model LIMIT 1) {k}_z" for k, (o, v) in _class_picks.items()
    ), "model_predictions",
))
def _(spark, sf):
    rows = model_predictions(spark, sf)
    table = M.with_gaps(M.evaluate_classes(rows, "class_true", "class_pred", ["model", K.PART]), [], _scores)
    seconds = rows.groupBy("model").agg(F.max("training_seconds").alias("training_seconds"))
    return ranking.best_models(table.join(seconds, "model"), ranking.CLASS_CRITERIA)


_ranks = (
    "SELECT model, rank() OVER (ORDER BY round(rmse_validation, 12)) AS rank_performance, rank() OVER (ORDER BY round(abs(rmse_gap), 12)) AS rank_generalization, "
    "rank() OVER (ORDER BY training_seconds) AS rank_training_time FROM regression_comparison"
)


@query("compromise_rank", sql(
    f"SELECT *, {r('(rank_performance + rank_generalization + rank_training_time) / 3.0')} AS compromise_score FROM ({_ranks}) z", "regression_comparison"
))
def _(spark, sf):
    ranked = ranking.compromise_rank(_comparison(spark, sf))
    return ranked.select("model", "rank_performance", "rank_generalization", "rank_training_time", "compromise_score")


@query("select_config", sql(
    f"WITH {class_sql('model_predictions', 'model, part')}, m AS (SELECT model, avg(f1) AS f FROM report WHERE part = 'validation' GROUP BY model), "
    "b AS (SELECT max(f) FILTER (WHERE model = 'forest') AS c, max(f) FILTER (WHERE model = 'boosting') AS d FROM m) "
    f"SELECT {r('c')} AS candidate_score, {r('d')} AS reference_score, {r('c - d')} AS gain, CASE WHEN round(c, 12) >= round(d, 12) THEN 'forest' ELSE 'boosting' END AS selected FROM b",
    "model_predictions",
))
def _(spark, sf):
    rows = model_predictions(spark, sf).where(name(K.PART) == "validation")
    return ranking.select_config(M.evaluate_classes(rows, "class_true", "class_pred", ["model"]), "forest", "boosting")


@query("cv_gap", sql(
    "WITH one AS (SELECT * FROM model_predictions WHERE model = 'forest'), folds AS (SELECT *, ntile(3) OVER (ORDER BY vehicle_record_id) AS f FROM one WHERE part = 'train'), "
    "cv AS (SELECT avg(mae) AS c FROM (SELECT f, avg(abs(y_true - y_pred)) AS mae FROM folds GROUP BY f) z), "
    "ext AS (SELECT avg(abs(y_true - y_pred)) AS v FROM one WHERE part = 'validation'), g AS (SELECT c, v, v - c AS gap, 100 * abs(v - c) / c AS p FROM cv, ext) "
    f"SELECT {r('c')} AS cv_mae, {r('v')} AS validation_mae, {r('gap')} AS gap, {r('abs(gap)')} AS gap_abs, {r('p')} AS gap_pct, "
    "CASE WHEN gap < 0 THEN 'validation better' WHEN p <= 5 THEN 'very close' WHEN p <= 10 THEN 'moderate loss' ELSE 'strong loss' END AS verdict FROM g",
    "model_predictions",
))
def _(spark, sf):
    one = model_predictions(spark, sf).where(F.col("model") == "forest")
    folds = k_folds(one.where(name(K.PART) == "train"), K.KEY, K.REGRESSION_FOLDS)
    inner = M.regression_metrics(folds, "y_true", "y_pred", ["fold"]).agg(F.avg("mae").alias("cv_mae")).withColumn("k", F.lit(1))
    outer = M.regression_metrics(one.where(name(K.PART) == "validation"), "y_true", "y_pred").select(
        F.col("mae").alias("validation_mae"), F.lit(1).alias("k")
    )
    both = inner.join(outer, "k").drop("k")
    return both.withColumns(M.cv_gap(F.col("cv_mae"), F.col("validation_mae")))
