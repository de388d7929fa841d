"""Learned values come from training rows only; every rule of the preparation."""

import json

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from fleetprep import contracts as K
from fleetprep.operators import checks as Q
from fleetprep.operators import prepare as P
from fleetprep.sources import artifacts as R

RULES = P.Rules(categorical=("c",), numeric=("x", "z", "m"), group="c", conditional={"x": ["a"]}, zero_fill=["z"], indicators={"x": "has_x"}, excluded=())
SCHEMA = "vehicle_record_id bigint, co2_wltp_g_km double, part string, c string, x double, z double, m double"
ROWS = [
    (1, 1.0, "train", "a", 2.0, 1.0, 1.0), (2, 1.0, "train", "a", 4.0, None, 3.0), (3, 1.0, "train", "b", 100.0, None, 5.0),
    (4, 1.0, "train", None, None, 2.0, None), (5, 1.0, "train", "b", None, 3.0, 7.0), (6, 1.0, "test", "q", None, None, None),
    (7, 1.0, "test", "a", None, 9.0, 9.0),
]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def test_fit_by_hand(spark):
    p = P.fit(table(spark), RULES)
    assert p.modes == {"c": "a"}  # a and b are equally frequent
    assert p.medians == {"x": 3.0, "m": 4.0}
    assert p.categories == {"c": ["a", "b"]}
    assert p.means["x"] == pytest.approx((2 + 4 + 100 + 3 + 0) / 5)
    out = {r[K.KEY]: r for r in P.imputed(table(spark), p, RULES).collect()}
    assert [out[i].x for i in range(1, 8)] == [2.0, 4.0, 100.0, 3.0, 0.0, 0.0, 3.0]
    assert [out[i].has_x for i in range(1, 8)] == [1, 1, 1, 0, 0, 0, 0]
    assert [out[i].z for i in range(1, 8)] == [1.0, 0.0, 0.0, 2.0, 3.0, 0.0, 9.0]
    assert out[6].m == 4.0
    ready = P.transform(table(spark), p, RULES)
    assert ready.columns == [K.KEY, K.TARGET, K.PART, "x", "z", "m", "has_x", "c_a", "c_b"]
    unseen = ready.where(f"{K.KEY} = 6").first()
    assert (unseen.c_a, unseen.c_b) == (0, 0)
    assert P.unseen_categories(table(spark), "part", ["c"]).collect() == [("c", "q", 1)]


def test_test_rows_teach_nothing(spark):
    changed = [r if r[2] == "train" else (r[0], 5.0, "test", "zzz", 1e9, 1e9, 1e9) for r in ROWS]
    assert P.fit(table(spark), RULES) == P.fit(table(spark, changed), RULES)


def test_nothing_to_learn_from(spark):
    empty = [(i, y, p, None, x, z, m) for i, y, p, _c, x, z, m in ROWS]
    with pytest.raises(ValueError, match="c"):
        P.fit(table(spark, empty), RULES)
    gone = [(i, y, p, c, x, z, None) for i, y, p, c, x, z, _m in ROWS]
    with pytest.raises(ValueError, match="m"):
        P.fit(table(spark, gone), RULES)


def test_constant_column_is_divided_by_one(spark):
    flat = [(i, y, p, c, x, z, 2.0) for i, y, p, c, x, z, _m in ROWS]
    p = P.fit(table(spark, flat), RULES)
    assert p.stds["m"] == 1.0
    assert {r.m for r in P.transform(table(spark, flat), p, RULES).collect()} == {0.0}


def test_uncovered_numeric_column_gets_its_median(spark):
    df = table(spark).withColumn("extra", F.when(F.col(K.KEY) != 7, F.col(K.KEY).cast("double")))
    p = P.fit(df, RULES)
    assert p.medians["extra"] == 3.0
    assert P.imputed(df, p, RULES).where(f"{K.KEY} = 7").first().extra == 3.0


def test_wide_categories_become_sparse_vectors(spark):
    """Twenty thousand categories: one vector column, unknown and missing values in one place of their own."""
    train = spark.range(40_000).select((F.col("id") % 20_000).cast("string").alias("c"))
    model = P.fit_wide(train, ["c"])
    rows = P.encode_wide(spark.createDataFrame([("7",), ("new",), (None,)], "c string"), model, ["c"]).collect()
    seven, new, missing = (r.c_vector for r in rows)
    assert seven.size >= 20_000 and seven.numNonzeros() == 1 and new == missing != seven


def test_incomplete_rows_are_refused(spark):
    with pytest.raises(ValueError, match="m, x, z"):
        P.require_complete(table(spark), ["m", "x", "z", "part"])


def test_params_round_trip(spark, folder, prepared):
    _, params, _ = prepared
    R.save_params(spark, folder + "/params", params)
    loaded = R.load_params(spark, folder + "/params")
    assert loaded == params
    Q.enforce(R.params_checks(spark, params, loaded))
    broken = P.Params(**{**json.loads(params.to_json()), "modes": {}})
    with pytest.raises(ValueError, match="modes_complete"):
        Q.enforce(R.params_checks(spark, params, broken))
    with pytest.raises(ValueError):
        P.Params.from_json("[1]")
    with pytest.raises(ValueError):
        R.save_json(spark, folder + "/list", [1])


def test_published_feature_layout(spark, prepared):
    rows, params, _ = prepared
    features = params.features(P.Rules())
    assert features[:10] == K.NUMERIC_FEATURES and features[10:14] == list(K.INDICATORS.values())
    assert "fuel_type_petrol/electric" in features and rows.columns == [K.KEY, K.TARGET, K.PART, *features]


def test_transform_is_one_projection(spark, prepared):
    """No shuffle, no join, no sort: parameters are literals, so the same code can run on a stream."""
    _, params, split = prepared
    plan = P.transform(split, params)._jdf.queryExecution().executedPlan().toString()
    for word in ("Exchange", "Join", "Sort", "Python"):
        assert word not in plan
    assert "ReadSchema" in plan and "manufacturer_make" not in plan.split("ReadSchema")[1]


def test_split_is_a_projection(spark, prepared):
    from fleetprep.operators.split import train_test_split

    _, _, split = prepared
    plan = train_test_split(split.drop("part"), K.KEY, "0.20", 42)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_no_cross_joins_or_python_in_registered_plans(spark):
    from __spark_entry__ import queries

    for label in ["class_distribution", "value_frequencies", "cut_quantile", "target_by_group", "normalize_make", "model_comparison"]:
        plan = queries()[label](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan
