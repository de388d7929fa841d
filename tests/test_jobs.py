"""Sources, sinks, whole jobs, models and the stream."""

import numpy as np
import pytest
from conftest import SMALL
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from fleetprep import contracts as K
from fleetprep.operators import models as M
from fleetprep.operators import prepare as P
from fleetprep.operators import search as S
from fleetprep.operators.checks import enforce
from fleetprep.plans import cleaning, features, preprocessing, training
from fleetprep.sources import artifacts as R
from fleetprep.sources import tables as IO
from fleetprep.streaming import apply as stream


def write_text(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_missing_tokens_and_types(spark, folder):
    path = folder + "/raw.csv"
    write_text(path, 'ID,Mk,m (kg),Ewltp (g/km),extra\n2,"A, ""B""",NA,12.5,x\n1.0,  ,1e3,NaN,\n3,null,abc,7,n/a\n')
    df = IO.scan_csv(spark, path)
    assert dict(df.dtypes)["ID"] == "bigint" and dict(df.dtypes)["m (kg)"] == "double"
    rows = df.orderBy("ID").collect()
    assert [tuple(r) for r in rows] == [(1, "  ", 1000.0, None, None), (2, 'A, "B"', None, 12.5, "x"), (3, None, None, 7.0, None)]
    assert [r.ID for r in IO.scan_csv(spark, path, rows=2).collect()] == [1, 2]


def test_parquet_scans(spark, folder):
    spark.range(5).select(F.col("id").cast("double").alias("y")).write.parquet(folder + "/y")
    assert IO.scan_parquet(spark, folder + "/y", 2).count() == 2
    assert IO.scan_target(spark, folder + "/y", "y").count() == 5
    with pytest.raises(ValueError):
        IO.scan_target(spark, folder + "/y", "z")
    spark.range(0).write.parquet(folder + "/none")
    with pytest.raises(ValueError):
        IO.scan_parquet(spark, folder + "/none")


def test_split_dataset(spark, folder):
    df = spark.createDataFrame([(1, 1.0, "train"), (2, 2.0, "test")], "k int, y double, part string")
    IO.write_split(df, folder + "/split")
    back = IO.load_split(spark, folder + "/split")
    x, y = IO.xy(back, "test", ["k"], "y")
    assert (x.first().k, y.first().y) == (2, 2.0)
    assert "PartitionFilters: [isnotnull(part" in x._jdf.queryExecution().executedPlan().toString()
    IO.write_split(df.where("part = 'train'"), folder + "/half")
    with pytest.raises(ValueError, match="test"):
        IO.load_split(spark, folder + "/half")


def test_reports(spark, folder):
    IO.write_report(spark.range(3).toDF("n"), folder + "/a")
    IO.write_report(spark.range(0).toDF("n"), folder + "/b")
    got = {r.report: (r.rows, r.ok) for r in IO.report_checks(spark, {x: f"{folder}/{x}" for x in "abc"}).collect()}
    assert got == {"a": (3, True), "b": (0, False), "c": (0, False)}


@pytest.fixture(scope="module")
def pipeline(spark):
    """The five jobs one after another, from a CSV under its source headers."""
    import tempfile

    from catalogue.inputs import source_rows

    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    headers = {c: h for h, c in K.SOURCE_NAMES.items()}
    raw = source_rows(spark, SMALL)
    IO.write_csv(raw.toDF(*[headers.get(c, c) for c in raw.columns]), folder + "/raw")
    cleaned = cleaning.clean_job(spark, folder + "/raw", folder + "/cleaned")
    built = features.feature_job(spark, folder + "/cleaned", folder + "/features")
    split = preprocessing.preprocess_job(spark, folder + "/features", folder + "/split", folder + "/params")
    return folder, cleaned, built, split


def test_jobs_agree_with_the_queries(spark, pipeline):
    from __spark_entry__ import queries

    _, cleaned, built, split = pipeline
    want = queries()["cleaned"](spark, SMALL)
    shown = cleaned.withColumn(K.DATE, F.date_format(K.DATE, "yyyy-MM-dd")).select(*want.columns)
    assert sorted(map(str, shown.collect())) == sorted(map(str, want.collect()))
    assert set(built.columns) == {K.KEY, *K.FEATURE_OUTPUT}
    assert {r.part: r["count"] for r in split.groupBy("part").count().collect()} == {
        "test": -(-cleaned.count() // 5), "train": cleaned.count() - -(-cleaned.count() // 5)
    }


def test_cleaned_table_is_stable(spark, pipeline):
    _, cleaned, _, _ = pipeline
    again = cleaning.clean(cleaned).rows
    assert sorted(again.columns) == sorted(cleaned.columns)
    assert sorted(map(str, again.select(*cleaned.columns).collect())) == sorted(map(str, cleaned.collect()))


def test_test_mode_keeps_constant_columns(spark, pipeline, tmp_path):
    folder, *_ = pipeline
    part = cleaning.clean_job(spark, folder + "/raw", str(tmp_path / "part"), rows=100)
    assert "status" in part.columns and part.count() <= 100


@pytest.mark.parametrize("classes", [False, True])
def test_training_job(spark, pipeline, tmp_path, classes):
    folder, *_ = pipeline
    params = {"n_estimators": 5, "max_depth": 8, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": 1.0}
    out = training.train_job(
        spark, folder + "/split", str(tmp_path / "model"), str(tmp_path / "meta"), classes, params, sample=800
    )
    meta = R.load_json(spark, str(tmp_path / "meta"))
    assert meta["features"] and meta["parameters"]["n_estimators"] == 5
    assert out.measures["macro_f1" if classes else "r2"] > 0.8
    if not classes:
        loaded = RandomForestRegressionModel.load(str(tmp_path / "model"))
        with pytest.raises(ValueError, match="feature_order"):
            enforce(R.model_checks(spark, out.model, loaded, meta["features"], {"features": []}, ({}, {})))


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    data = M.assemble(df, ["a", "b", "c"], "y")
    model = M.ridge(data, 50.0).fit(data)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 50 * np.eye(3), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(want, abs=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want, abs=1e-6)


def test_model_quality_on_the_fixture(spark, prepared):
    rows, _, _ = prepared
    data = training.vectors(rows, classes=False)
    forest = {"n_estimators": 10, "max_depth": 12, "max_features": 1.0}
    scores = {r.part: r for r in M.evaluate("f", M.forest_regressor(forest, 42), data, K.PART, False).measures.collect()}
    assert scores["test"].r2 > 0.95 and scores["train"].r2 >= scores["test"].r2


def test_regression_study(spark, prepared):
    rows, _, _ = prepared
    forest = [{"n_estimators": 3, "max_depth": d, "max_features": 1.0} for d in (2, 6)]
    boosting = [{"learning_rate": 0.1, "max_iter": 2, "max_leaf_nodes": 15, "min_samples_leaf": 20}]
    spaces = {"forest": (M.forest_regressor, forest), "boosting": (M.boosting_regressor, boosting)}
    study = training.regression_study(rows, spaces, folds=2, rows=600)
    assert study.selected == "forest" and study.test.first().part == "test"
    assert S.best_params(study.searches["forest"])["max_depth"] == 6
    assert study.comparison.columns[0] == "model" and study.comparison.count() == 2


def test_class_test_reports(spark, prepared):
    rows, _, _ = prepared
    out = training.final_classification(rows, M.forest_classifier({"n_estimators": 5, "max_depth": 8, "max_features": 1.0}, 42))
    n = rows.where("part = 'test'").count()
    assert out.measures.first()["rows"] == n == sum(r.support for r in out.per_class.collect())
    assert sum(r[c] for r in out.confusion.collect() for c in K.CLASS_LABELS) == n


def test_parameter_spaces():
    assert S.combinations(K.REGRESSION_FOREST_SPACE) == 324
    assert S.combinations(K.REGRESSION_BOOSTING_SPACE) == 324
    assert S.combinations(K.CLASSIFICATION_FOREST_SPACE) == 324
    drawn = S.draw(K.REGRESSION_FOREST_SPACE, 8, 42)
    assert len({str(d) for d in drawn}) == 8 and drawn == S.draw(K.REGRESSION_FOREST_SPACE, 8, 42)
    assert len(S.draw({"a": [1, 2]}, 8, 42)) == 2


def test_spaces_report(spark):
    spaces = {"forest": K.REGRESSION_FOREST_SPACE, "boosting": K.REGRESSION_BOOSTING_SPACE}
    assert {(r.space, r.parameters, r.combinations) for r in S.spaces_report(spark, spaces).collect()} == {("forest", 5, 324), ("boosting", 5, 324)}


def test_parameter_mapping():
    assert M.min_instances({"min_samples_leaf": 1, "min_samples_split": 10}) == 5
    assert M.forest_regressor({"n_estimators": 3, "max_depth": None}, 1).getMaxDepth() == 30
    assert M.forest_classifier({"n_estimators": 3, "max_depth": 20, "max_features": 0.5}, 1).getFeatureSubsetStrategy() == "0.5"
    assert M.boosting_regressor({"max_leaf_nodes": 63}, 1).getMaxDepth() == 6


def test_ranks_of_models(spark):
    from fleetprep.operators import ranking

    rows = [("a", 1.0, 2.0, 0.9, 0.5, 10.0), ("b", 2.0, 1.0, 0.8, -0.1, 10.0), ("c", 2.0, 1.0, 0.8, 0.1, 1.0)]
    df = spark.createDataFrame(rows, "model string, mae_validation double, rmse_validation double, r2_validation double, rmse_gap double, training_seconds double")
    ranked = {r.model: r for r in ranking.compromise_rank(df).collect()}
    assert [ranked[m].rank_performance for m in "abc"] == [3, 1, 1]
    assert [ranked[m].rank_generalization for m in "abc"] == [3, 1, 1]
    assert [ranked[m].rank_training_time for m in "abc"] == [2, 2, 1]
    assert ranking.compromise_candidate(ranking.compromise_rank(df)).first().model == "c"
    best = {r.criterion: r.model for r in ranking.best_models(df).collect()}
    assert best == {"best_mae": "a", "best_rmse": "b", "best_r2": "a", "fastest": "c", "most_stable": "b"}


def test_stream_equals_batch(spark, prepared, folder):
    _, params, split = prepared
    split.drop(K.PART).repartition(3).write.parquet(folder + "/in")
    rows = stream.read_features(spark, folder + "/in", split.drop(K.PART).schema)
    stream.write_prepared(rows, params, folder + "/out", folder + "/checkpoint").awaitTermination()
    got = spark.read.parquet(folder + "/out")
    want = P.transform(split.drop(K.PART), params).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_shared_folder_is_the_configured_one(spark):
    from fleetprep.cluster import shared_folder, stage

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3))
    assert staged.inputFiles()[0].removeprefix("file://").startswith(shared_folder(spark)) and staged.count() == 3
