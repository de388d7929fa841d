"""JSON objects, learned parameters and fitted models in shared storage."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession

from fleetprep.operators.prepare import Params, Rules


def save_json(spark: SparkSession, path: str, data: dict) -> None:
    """One small JSON object, written through Spark so that any storage works."""
    if not isinstance(data, dict):
        raise ValueError("the root must be an object")
    text = json.dumps(data, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one JSON object in {path}")
    data = json.loads(rows[0][0])
    if not isinstance(data, dict):
        raise ValueError("the root must be an object")
    return data


def save_params(spark: SparkSession, path: str, params: Params) -> None:
    save_json(spark, path, json.loads(params.to_json()))


def load_params(spark: SparkSession, path: str) -> Params:
    return Params.from_json(json.dumps(load_json(spark, path)))


def params_checks(spark: SparkSession, saved: Params, loaded: Params, rules: Rules = Rules()) -> DataFrame:
    """(check, ok): complete, finite, consistent widths, same feature order as when saved."""
    finite = lambda values: all(v is not None and math.isfinite(v) for v in values)
    tests = {
        "schema_version": loaded.schema_version == saved.schema_version,
        "modes_complete": set(loaded.modes) == set(rules.categorical) and all(loaded.modes.values()),
        "medians_complete": set(rules.medians) | set(rules.conditional) <= set(loaded.medians),
        "medians_finite": finite(loaded.medians.values()),
        "encoder_columns": list(loaded.categories) == list(saved.categories),
        "encoder_width": sum(map(len, loaded.categories.values())) == sum(map(len, saved.categories.values())),
        "scaler_width": len(loaded.means) == len(loaded.stds) == len(rules.numeric),
        "scaler_finite": finite([*loaded.means.values(), *loaded.stds.values()]),
        "scaler_positive": all(s > 0 for s in loaded.stds.values()),
        "feature_order": loaded.features(rules) == saved.features(rules),
        "same_values": loaded == saved,
    }
    return spark.createDataFrame(list(tests.items()), "check string, ok boolean")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def model_checks(spark: SparkSession, fitted, loaded, features: list[str], metadata: dict, metrics: tuple[dict, dict]) -> DataFrame:
    """(check, ok): class, feature count and order, and measures of a reloaded model agree with the fitted one."""
    before, after = metrics
    same = lambda a, b: abs(a - b) <= 1e-9 * max(1.0, abs(a))
    tests = {
        "same_class": type(fitted) is type(loaded),
        "feature_count": getattr(loaded, "numFeatures", len(features)) == len(features),
        "feature_order": metadata.get("features") == list(features),
        "same_metrics": before.keys() == after.keys() and all(same(before[k], after[k]) for k in before),
    }
    return spark.createDataFrame(list(tests.items()), "check string, ok boolean")
