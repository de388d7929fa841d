"""Feature table to prepared training and test rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetprep import contracts as K
from fleetprep.cluster import stage
from fleetprep.operators import checks as Q
from fleetprep.operators.prepare import Params, Rules, fit, transform
from fleetprep.operators.split import train_test_split
from fleetprep.sources.artifacts import load_params, params_checks, save_params
from fleetprep.sources.tables import load_split, scan_features, write_split

RULES = Rules()


@dataclass
class Prepared:
    split: DataFrame
    params: Params
    rows: DataFrame


def input_checks(df: DataFrame) -> DataFrame:
    return Q.input_checks(df, K.PREPARE_REQUIRED, K.NUMERIC_FEATURES, K.TARGET)


def prepare(df: DataFrame, rules: Rules = RULES) -> Prepared:
    """Split, learn on the training rows, transform all rows in one projection.

    The feature table is read once for the split marks and once per learned set (categories, medians, moments), so it
    should be a stored table.
    """
    split = train_test_split(df, rules.key, K.TEST_SHARE, K.SEED, rules.part)
    params = fit(split, rules)
    return Prepared(split, params, transform(split, params, rules))


def matrix_checks(prepared: DataFrame, params: Params, rules: Rules = RULES) -> DataFrame:
    return Q.matrix_checks(
        prepared, rules.part, params.features(rules), rules.target, rules.categorical, rules.excluded, list(rules.indicators.values())
    )


def preprocess_job(spark: SparkSession, source: str, data: str, artifacts: str, rows: int | None = None) -> DataFrame:
    """CSV to a Parquet dataset by part, and the learned parameters as JSON; everything is read back and checked."""
    table = stage(scan_features(spark, source, rows))
    Q.enforce(input_checks(table))
    result = prepare(table)
    Q.enforce(matrix_checks(result.rows, result.params))
    write_split(result.rows, data)
    save_params(spark, artifacts, result.params)
    Q.enforce(params_checks(spark, result.params, load_params(spark, artifacts)))
    return load_split(spark, data)
