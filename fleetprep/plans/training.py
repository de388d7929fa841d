"""Training jobs and model selection on prepared rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep import contracts as K
from fleetprep.cluster import stage
from fleetprep.functions.text import name
from fleetprep.operators import models as M
from fleetprep.operators.checks import enforce, training_checks
from fleetprep.operators.discretize import emission_class
from fleetprep.operators.metrics import class_report, classification_metrics, confusion_counts, confusion_matrix, with_gaps
from fleetprep.operators.search import best_params, macro_f1_score, mae_score, random_search
from fleetprep.operators.split import development_sample, k_folds, sample_rows, stratified_folds, stratified_sample, stratified_split
from fleetprep.sources.artifacts import load_json, model_checks, save_json, save_model
from fleetprep.sources.tables import load_split

CLASS_INDEX = "class_index"


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (K.KEY, K.TARGET, K.PART, K.CLASS, CLASS_INDEX, "fold")]


def with_classes(df: DataFrame) -> DataFrame:
    """Add the class label of the target and its position in the label list."""
    labelled = emission_class(df, K.TARGET, K.CLASS_BOUNDS, K.CLASS_LABELS, K.CLASS)
    return M.class_index(labelled, K.CLASS, K.CLASS_LABELS, CLASS_INDEX)


def vectors(df: DataFrame, classes: bool, keep: Sequence[str] = (K.KEY, K.PART)) -> DataFrame:
    """Key, part, features and label; the class label too if classes are learned."""
    features = feature_columns(df)
    if not classes:
        return M.assemble(df, features, K.TARGET, keep)
    return M.assemble(with_classes(df), features, CLASS_INDEX, [*keep, K.CLASS])


# ---- comparing models on the development rows ----

def development(prepared: DataFrame, rows: int | None = None, classes: bool = False) -> DataFrame:
    """The training rows, or a sample of them, split into train and validation; class shares are kept when classes are learned."""
    train = prepared.where(name(K.PART) == "train").drop(K.PART)
    if not classes:
        return development_sample(train, K.KEY, rows, K.TEST_SHARE, K.SEED, K.PART)
    labelled = with_classes(train)
    sample = labelled if rows is None else stratified_sample(labelled, K.KEY, K.CLASS, rows, f"{K.SEED}|sample")
    split = stratified_split(sample, K.KEY, K.CLASS, K.TEST_SHARE, f"{K.SEED}|validation", K.PART)
    return split.withColumn(K.PART, F.when(name(K.PART) == "test", "validation").otherwise("train")).drop(K.CLASS, CLASS_INDEX)


def compare(data: DataFrame, estimators: Mapping[str, Estimator], classes: bool) -> DataFrame:
    """One row per model: measures on train and validation, gaps, training time; best validation first."""
    measures = None
    for label, estimator in estimators.items():
        lines = M.evaluate(label, estimator, data, K.PART, classes).measures
        measures = lines if measures is None else measures.unionByName(lines)
    errors, scores = ([], ["accuracy", "balanced_accuracy", "macro_f1", "weighted_f1"]) if classes else (["mae", "rmse"], ["r2"])
    table = with_gaps(measures, errors, scores)
    seconds = measures.groupBy("model").agg(F.max("training_seconds").alias("training_seconds"))
    order = F.desc("macro_f1_validation") if classes else F.asc("rmse_validation")
    return table.join(seconds, "model").orderBy(order)


def search(
    data: DataFrame, build: Callable[[dict], Estimator], candidates: Sequence[dict], classes: bool, folds: int
) -> list[dict]:
    """Randomised search on the train part of the development rows."""
    train = data.where(name(K.PART) == "train")
    folded = (
        stratified_folds(train, K.KEY, K.CLASS, folds, K.SEED) if classes else k_folds(train, K.KEY, folds)
    )
    return random_search(folded, "fold", folds, build, candidates, macro_f1_score if classes else mae_score)


def final_regression(prepared: DataFrame, estimator: Estimator, rows: int | None = None) -> DataFrame:
    """Refit on all development rows, then one use of the test rows: (part, rows, mae, rmse, r2)."""
    dev = development(prepared, rows).drop(K.PART)
    model, _ = M.fit_timed(estimator, vectors(dev, classes=False, keep=[K.KEY]))
    test = vectors(prepared.where(name(K.PART) == "test"), classes=False)
    return M.regression_measures(model, test, K.PART)


@dataclass
class RegressionStudy:
    searches: dict[str, list[dict]]
    comparison: DataFrame
    selected: str
    test: DataFrame


def regression_study(
    prepared: DataFrame,
    spaces: Mapping[str, tuple[Callable[[dict, int], Estimator], Sequence[dict]]],
    folds: int = K.REGRESSION_FOLDS,
    rows: int | None = None,
) -> RegressionStudy:
    """Search every model's candidates, compare the best ones on the validation rows, refit the one with the lowest RMSE
    on all development rows and score it once on the test rows. spaces maps a name to (build(params, seed), candidates)."""
    data = stage(vectors(development(prepared, rows), classes=False))
    searches = {
        label: search(data, lambda p, build=build: build(p, K.SEED), candidates, False, folds) for label, (build, candidates) in spaces.items()
    }
    tuned = {label: spaces[label][0](best_params(found), K.SEED) for label, found in searches.items()}
    comparison = compare(data, tuned, classes=False)
    selected = comparison.first()["model"]
    return RegressionStudy(searches, comparison, selected, final_regression(prepared, tuned[selected], rows))


@dataclass
class ClassTest:
    measures: DataFrame
    per_class: DataFrame
    confusion: DataFrame


def final_classification(prepared: DataFrame, estimator: Estimator, rows: int | None = None) -> ClassTest:
    """The model of the development train rows, without a refit, on the test rows: measures, per class, confusion."""
    dev = vectors(development(prepared, rows, classes=True), classes=True)
    model, _ = M.fit_timed(estimator, dev.where(name(K.PART) == "train"))
    test = vectors(prepared.where(name(K.PART) == "test"), classes=True)
    predicted = M.class_label(model.transform(test), M.PREDICTION, K.CLASS_LABELS, "predicted_class")
    # at most one row per pair of classes, so the three reports share one pass over the test rows
    counts = stage(confusion_counts(predicted, K.CLASS, "predicted_class"))
    per_class = class_report(counts, K.CLASS_LABELS)
    return ClassTest(classification_metrics(per_class), per_class, confusion_matrix(counts, K.CLASS_LABELS))


# ---- the training jobs ----

@dataclass
class Trained:
    model: Model
    measures: dict[str, float]
    seconds: float


def train_job(
    spark: SparkSession, data: str, model_path: str, metadata_path: str, classes: bool,
    params: Mapping | None = None, sample: int | None = None,
) -> Trained:
    """Load the split, check it, fit on the training rows, score the test rows, save, reload and score again."""
    params = dict(params or (K.CLASSIFICATION_FOREST if classes else K.REGRESSION_FOREST))
    table = load_split(spark, data)
    features = feature_columns(table)
    enforce(training_checks(table, K.PART, features, K.TARGET, K.MODEL_EXCLUDED, infinite=classes))
    train = table.where(name(K.PART) == "train")
    if sample is not None and classes:
        labelled = with_classes(train)
        train = stratified_sample(labelled, K.KEY, K.CLASS, sample, K.SEED).drop(K.CLASS, CLASS_INDEX)
    elif sample is not None:
        train = sample_rows(train, K.KEY, sample, K.SEED)
    build = M.forest_classifier if classes else M.forest_regressor
    model, seconds = M.fit_timed(build(params, K.SEED), vectors(train, classes))
    test = vectors(table.where(name(K.PART) == "test"), classes)
    measure = M.classification_measures if classes else M.regression_measures
    scores = measure(model, test, K.PART).drop(K.PART).first().asDict()
    save_model(model, model_path)
    save_json(spark, metadata_path, {
        "features": features, "parameters": params, "measures": scores, "training_seconds": seconds, "target": K.TARGET,
        **({"labels": K.CLASS_LABELS, "bounds": K.CLASS_BOUNDS_TEXT} if classes else {}),
    })
    loaded = (RandomForestClassificationModel if classes else RandomForestRegressionModel).load(model_path)
    again = measure(loaded, test, K.PART).drop(K.PART).first().asDict()
    enforce(model_checks(spark, model, loaded, features, load_json(spark, metadata_path), (scores, again)))
    return Trained(model, scores, seconds)
