"""Choosing between models from their measures: one row per model, so windows here stay tiny."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetprep.functions.text import name


PLACES = 12


def settled(score: Column) -> Column:
    """Score without the last digits, which depend on the order in which a cluster adds up; equal scores stay equal."""
    return F.round(score.cast("double"), PLACES)


REGRESSION_CRITERIA = {
    "best_mae": (F.col, "mae_validation", 1), "best_rmse": (F.col, "rmse_validation", 1), "best_r2": (F.col, "r2_validation", -1),
    "fastest": (F.col, "training_seconds", 1), "most_stable": (F.abs, "rmse_gap", 1),
}
CLASS_CRITERIA = {
    "best_macro_f1": (F.col, "macro_f1_validation", -1), "fastest": (F.col, "training_seconds", 1), "most_stable": (F.abs, "macro_f1_gap", 1),
}


def best_models(comparison: DataFrame, criteria=REGRESSION_CRITERIA, model: str = "model") -> DataFrame:
    """(criterion, model, value): the first model by each criterion, 1 for smallest and -1 for largest; ties to the first name."""
    m = name(model)
    picks = {k: (of(column).cast("double"), sign) for k, (of, column, sign) in criteria.items()}
    one = comparison.agg(*[
        F.min_by(F.struct(m.alias("model"), v.alias("value")), F.struct(settled(v * sign), m)).alias(k) for k, (v, sign) in picks.items()
    ])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("criterion"), F.col(f"{k}.model").alias("model"), F.col(f"{k}.value").alias("value")) for k in picks
    ])))


def compromise_rank(comparison: DataFrame) -> DataFrame:
    """Add the ranks by error, by stability and by training time (ties share the lowest), and their mean."""
    def rank(c):
        return F.rank().over(Window.partitionBy(F.lit(1)).orderBy(settled(c)))

    ranked = (
        comparison.withColumn("rank_performance", rank(F.col("rmse_validation")))
        .withColumn("rank_generalization", rank(F.abs("rmse_gap")))
        .withColumn("rank_training_time", rank(F.col("training_seconds")))
    )
    total = F.col("rank_performance") + F.col("rank_generalization") + F.col("rank_training_time")
    return ranked.withColumn("compromise_score", total / F.lit(3.0))


def compromise_candidate(ranked: DataFrame, model: str = "model") -> DataFrame:
    return ranked.agg(F.min_by(model, F.struct("compromise_score", model)).alias(model))


def rank_results(results: DataFrame, score: str, higher_is_better: bool) -> DataFrame:
    """Tuning results with a rank by mean score, best first."""
    order = settled(name(score)).desc() if higher_is_better else settled(name(score)).asc()
    return results.withColumn("rank", F.rank().over(Window.partitionBy(F.lit(1)).orderBy(order))).orderBy("rank")


def select_config(metrics: DataFrame, candidate: str, reference: str, model: str = "model", score: str = "macro_f1") -> DataFrame:
    """(candidate_score, reference_score, gain, selected): the candidate is kept if it is at least as good."""
    of = lambda m: F.max(F.when(name(model) == m, name(score)))
    both = metrics.agg(of(candidate).alias("candidate_score"), of(reference).alias("reference_score"))
    keep = settled(F.col("candidate_score")) >= settled(F.col("reference_score"))
    return both.select(
        "candidate_score", "reference_score", (F.col("candidate_score") - F.col("reference_score")).alias("gain"),
        F.when(keep, F.lit(candidate)).otherwise(F.lit(reference)).alias("selected"),
    )
