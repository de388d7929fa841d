"""Randomised search over parameter spaces with prepared folds."""

from __future__ import annotations

import itertools
import json
import math
import random
import statistics
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession

from fleetprep.cluster import spread
from fleetprep.functions.text import name
from fleetprep.operators.metrics import evaluate_classes, regression_metrics
from fleetprep.operators.models import LABEL, PREDICTION, fit_timed
from fleetprep.operators.ranking import rank_results


def combinations(space: Mapping[str, Sequence]) -> int:
    return math.prod(len(v) for v in space.values())


def draw(space: Mapping[str, Sequence], n: int, seed: int) -> list[dict]:
    """n different parameter sets, the same ones for the same seed; all of them if there are no more than n."""
    grid = list(itertools.product(*space.values()))
    picked = grid if n >= len(grid) else random.Random(seed).sample(grid, n)
    return [dict(zip(space, values)) for values in picked]


def mae_score(predictions: DataFrame) -> float:
    return -regression_metrics(predictions, LABEL, PREDICTION).first()["mae"]


def macro_f1_score(predictions: DataFrame) -> float:
    return evaluate_classes(predictions, LABEL, PREDICTION).first()["macro_f1"]


def random_search(
    df: DataFrame,
    fold: str,
    folds: int,
    build: Callable[[dict], Estimator],
    candidates: Sequence[dict],
    score: Callable[[DataFrame], float],
    train_scores: bool = False,
    parallelism: int = 2,
) -> list[dict]:
    """One record per candidate: params, score of every fold, mean, deviation, mean fit time. Higher scores are better.

    The folds are a column of the table, so each is a filter on one stored copy; only scores come back to the driver.
    """
    df = spread(df).persist(StorageLevel.MEMORY_AND_DISK)

    def run(job: tuple[int, int]) -> tuple[int, float, float, float | None]:
        c, f = job
        train, held_out = df.where(name(fold) != f), df.where(name(fold) == f)
        model, seconds = fit_timed(build(candidates[c]), train, keep=False)
        inner = score(model.transform(train)) if train_scores else None
        return c, score(model.transform(held_out)), seconds, inner

    try:
        jobs = list(itertools.product(range(len(candidates)), range(folds)))
        with ThreadPoolExecutor(parallelism) as pool:
            done = list(pool.map(run, jobs))
    finally:
        df.unpersist()
    out = []
    for c, params in enumerate(candidates):
        scores = [s for i, s, _, _ in done if i == c]
        record = {
            "params": params, "scores": scores, "mean_score": statistics.fmean(scores), "std_score": statistics.pstdev(scores),
            "mean_fit_seconds": statistics.fmean(t for i, _, t, _ in done if i == c),
        }
        if train_scores:
            record["mean_train_score"] = statistics.fmean(t for i, _, _, t in done if i == c)
        out.append(record)
    return out


def best_params(results: Sequence[dict]) -> dict:
    return max(results, key=lambda r: r["mean_score"])["params"]


def tuning_report(spark: SparkSession, results: Sequence[dict]) -> DataFrame:
    """(candidate, params, mean_score, std_score, mean_fit_seconds, rank), best first."""
    rows = [
        (i, json.dumps(r["params"], sort_keys=True), float(r["mean_score"]), float(r["std_score"]), float(r["mean_fit_seconds"]))
        for i, r in enumerate(results)
    ]
    table = spark.createDataFrame(
        rows, "candidate int, params string, mean_score double, std_score double, mean_fit_seconds double"
    )
    return rank_results(table, "mean_score", higher_is_better=True)


def spaces_report(spark: SparkSession, spaces: Mapping[str, Mapping[str, Sequence]]) -> DataFrame:
    """(space, parameters, combinations)."""
    rows = [(label, len(space), combinations(space)) for label, space in spaces.items()]
    return spark.createDataFrame(rows, "space string, parameters int, combinations int")
