"""Quantiles, ranks, splits, bins and measures against plain Python."""

import hashlib
import math
import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetprep.operators import discretize as D
from fleetprep.operators import metrics as E
from fleetprep.operators import profile as A
from fleetprep.operators import quantiles as Q
from fleetprep.operators import ranks as R
from fleetprep.operators import split as S

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def quantile_rows(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double, y double")
    out = Q.quantiles(df, {"x": F.col("x"), "y": F.col("y")}, PROBS, by=["g"])
    return {(r.g, r.variable): [r[f"q{j}"] for j in range(len(PROBS))] for r in out.collect()}


def test_quantiles_equal_numpy(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0.0, rng.gauss(0, 1e6), rng.random(), None]), float(rng.randint(0, 3))) for _ in range(4000)]
    rows += [("hot", 7.0, None)] * 2000 + [("one", 1.5, None)]
    counted = quantile_rows(spark, rows)
    assert len(counted) == 10
    for key, values in counted.items():
        data = [r[1 if key[1] == "x" else 2] for r in rows if r[0] == key[0]]
        data = [v for v in data if v is not None]
        if not data:
            assert values == [None] * len(PROBS)
            continue
        assert values == pytest.approx(np.quantile(data, PROBS).tolist(), rel=1e-12, abs=1e-12)


def test_quantiles_of_many_different_values_in_one_group(spark):
    """Two million different values, most of them within one narrow range of one group."""
    df = spark.range(2_000_000).select(
        F.when(F.col("id") % 1000 == 0, "small").otherwise("hot").alias("g"),
        F.when(F.col("id") % 1000 == 0, F.col("id") * 1.0).otherwise(F.lit(1e9) + F.col("id") / 1e3).alias("x"),
    )
    out = Q.quantiles(df, {"x": F.col("x")}, [0.25, 0.5], by=["g"])
    ids = np.arange(2_000_000)
    hot, small = 1e9 + ids[ids % 1000 != 0] / 1e3, ids[ids % 1000 == 0] * 1.0
    got = {r.g: [r.q0, r.q1] for r in out.collect()}
    assert got["hot"] == pytest.approx(np.quantile(hot, [0.25, 0.5]).tolist(), rel=1e-12)
    assert got["small"] == pytest.approx(np.quantile(small, [0.25, 0.5]).tolist(), rel=1e-12)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "SinglePartition" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=40))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = Q.quantiles(df, {"x": F.col("x")}, [0.3, 0.5]).first()
    assert [got.q0, got.q1] == pytest.approx(np.quantile(values, [0.3, 0.5]).tolist(), rel=1e-9, abs=1e-9)


def positions(*wanted):
    return lambda sizes: sizes.select("s", F.explode(F.array(*[F.lit(p) for p in wanted])).alias("p"))


@pytest.mark.parametrize("bits, leaf", [(14, 16_384), (4, 1)])
def test_marks_after_any_number_of_passes(spark, monkeypatch, bits, leaf):
    monkeypatch.setattr(R, "STEP_BITS", bits)
    monkeypatch.setattr(R, "LEAF_ROWS", leaf)
    rng = random.Random(3)
    keys = rng.sample(range(-500, 10**4), 60) if bits < 14 else [*{rng.randint(-9 * 10**18, 9 * 10**18) for _ in range(58)}, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(k, ["a", "b", None][k % 3]) for k in keys], "k bigint, s string")
    limits = R.bounds(df, F.col("k"))
    marks = {m.p: m.x for m in R.marks_at(df, F.col("k"), F.col("k"), *limits, positions(1, 2, 31, 60)).collect()}
    assert marks == {p: sorted(keys)[p - 1] for p in (1, 2, 31, 60)}
    last = lambda sizes: sizes.select("s", F.col("n").alias("p"))
    marks = R.marks_at(df, F.col("k"), F.col("k"), *limits, last, F.col("s")).collect()
    groups = {"=a": 0, "=b": 1, "": 2}
    assert {(m.s, m.p, m.x) for m in marks} == {(s, len(own), max(own)) for s, r in groups.items() for own in [[k for k in keys if k % 3 == r]]}


def test_copies_of_one_key_share_their_place(spark, monkeypatch):
    monkeypatch.setattr(R, "LEAF_ROWS", 2)
    df = spark.createDataFrame([(5,)] * 10 + [(9,)], "k bigint")
    marks = {m.p: (m.x, m.upto) for m in R.marks_at(df, F.col("k"), F.col("k"), 5, 9, positions(4, 11)).collect()}
    assert marks == {4: (5, 10), 11: (9, 11)}
    with pytest.raises(ValueError):
        R.marks_at(df, F.col("k"), F.col("k"), 5, 9, positions(12))


def test_sizes_are_exact_or_refused(spark):
    """Missing and repeated keys, missing strata; sizes below, at and above the number of rows."""
    keyed = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("c"))
    for rows in (1, 89, 90, 99, 100, 101):
        assert S.stratified_sample(keyed, "k", "c", rows, 1).count() == min(rows, 100)
        assert S.sample_rows(keyed, "k", rows, 1).count() == min(rows, 100)
    sizes = {(r.c, r.part): r["count"] for r in S.stratified_split(keyed, "k", "c", "0.20", 3).groupBy("c", "part").count().collect()}
    assert sizes == {("s0", "test"): 6, ("s0", "train"): 24, ("s1", "test"): 6, ("s1", "train"): 24, ("s2", "test"): 6, ("s2", "train"): 24, (None, "test"): 2, (None, "train"): 8}
    one_missing = keyed.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    assert S.train_test_split(one_missing, "k", "0.20", 42).where("part = 'test'").count() == 20
    assert S.k_folds(one_missing, "k", 3).groupBy("fold").count().orderBy("fold").collect() == [(0, 34), (1, 33), (2, 33)]
    twice = spark.range(100).select((F.col("id") % 50).alias("k"))
    with pytest.raises(ValueError, match="must be unique"):
        S.train_test_split(twice, "k", "0.25", 42).count()
    assert S.sample_rows(twice, "k", 100, 1).count() == 100


def test_many_strata(spark):
    df = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") % 1500).cast("string").alias("c"))
    folds = S.stratified_folds(df, "k", "c", 3, 1).groupBy("c").pivot("fold", [0, 1, 2]).count().distinct().collect()
    assert {(r["0"], r["1"], r["2"]) for r in folds} == {(2, 1, 1)}


@pytest.mark.parametrize("n", [0, 1, 4, 5, 11, 101])
def test_split_sizes_and_order(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    rows = S.train_test_split(df, "k", "0.20", 42).collect()
    test = {r.k for r in rows if r.part == "test"}
    by_hash = sorted(range(n), key=lambda k: hashlib.md5(f"{k}|42".encode()).hexdigest())
    assert test == set(by_hash[: -(-n // 5)]) and len(rows) == n


def test_exact_rows_has_no_float_overshoot():
    assert S.exact_rows(10_758_184, "0.20") == 2_151_637
    assert S.exact_rows(5, "0.20") == 1 and S.exact_rows(6, "0.20") == 2


def test_sample_and_development_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert S.sample_rows(df, "k", 137, 1).count() == 137
    assert S.sample_rows(df, "k", 5000, 1).count() == 1000
    dev = S.development_sample(df, "k", 300, "0.20", 42).groupBy("part").count().collect()
    assert {r.part: r["count"] for r in dev} == {"train": 240, "validation": 60}


def test_small_strata(spark):
    rows = [(i, c) for i, c in enumerate("a" + "bb" + "ccccccc")]
    df = spark.createDataFrame(rows, "k bigint, c string")
    out = S.stratified_split(df, "k", "c", "0.20", 7).where("part = 'test'").groupBy("c").count().collect()
    assert sum(r["count"] for r in out) == 2
    shares = lambda counts, rows: {r.s: r.p for r in S.allocate(spark.createDataFrame(list(counts.items()), "s string, n long"), rows).collect()}
    assert shares({"a": 1, "b": 2, "c": 7}, 2) == {"a": 0, "b": 1, "c": 1}
    assert shares({"x": 5, "y": 5}, 5) == {"x": 3, "y": 2}
    assert shares({"a": 10**12, "b": 10**12}, 10**12 + 1) == {"a": 5 * 10**11 + 1, "b": 5 * 10**11}
    assert S.stratified_sample(df, "k", "c", 5, 7).count() == 5
    assert S.stratified_sample(df, "k", "c", 50, 7).count() == 10


def test_folds(spark):
    df = spark.range(11).select((F.col("id") * 7).alias("k"), F.when(F.col("id") < 4, "a").otherwise("b").alias("c"))
    folds = [r.fold for r in S.k_folds(df, "k", 3).orderBy("k").collect()]
    assert folds == [0] * 4 + [1] * 4 + [2] * 3
    sizes = {(r.c, r.fold): r["count"] for r in S.stratified_folds(df, "k", "c", 3, 42).groupBy("c", "fold").count().collect()}
    assert sizes == {("a", 0): 2, ("a", 1): 1, ("a", 2): 1, ("b", 0): 3, ("b", 1): 2, ("b", 2): 2}
    assert {r.fold for r in S.k_folds(df.limit(1), "k", 3).collect()} == {0}


def test_split_overlap(spark):
    a, b = spark.range(0, 10).withColumnRenamed("id", "k"), spark.range(8, 20).withColumnRenamed("id", "k")
    assert S.split_overlap(a, b, "k").first().shared == 2


def test_uniform_edges_hold_the_smallest_value(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 11.0)], "x double")
    edges = D.uniform_edges(df, "x", 5)
    assert edges == pytest.approx([0.99, 3.0, 5.0, 7.0, 9.0, 11.0])
    counts = D.bin_counts(df, "x", {"u": edges}).orderBy("bin").collect()
    assert [r.n for r in counts] == [3, 0, 0, 0, 1]
    flat = D.uniform_edges(spark.createDataFrame([(2.0,)], "x double"), "x", 2)
    assert flat[0] < 2.0 < flat[-1]


def test_bins_per_row_and_classes_without_rows(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 3.0, 3.5)], "x double")
    assert [r.bin for r in D.with_bin(df, "x", [1.0, 3.0, 4.0]).collect()] == [1, 1, 2]
    found = D.class_distribution(df, "x", [3.0], ["A", "B"], {"A": "a", "B": "b"}, {"A": "", "B": ""})
    D.require_all_classes(found)
    with pytest.raises(ValueError, match="B"):
        D.require_all_classes(D.class_distribution(df, "x", [3.0, 3.2], ["A", "B", "C"], dict.fromkeys("ABC", ""), dict.fromkeys("ABC", "")))


def test_quantile_edges_are_merged(spark):
    df = spark.createDataFrame([(v,) for v in [0.0] * 6 + [1.0, 2.0, 3.0]], "x double")
    assert D.quantile_edges(df, "x", [3])[3] == pytest.approx([0.0, 1 / 3, 3.0])
    assert D.quantile_edges(df, "x", [2])[2] == [0.0, 3.0]


def test_histogram_of_one_value(spark):
    out = A.histogram(spark.createDataFrame([(4.0,), (4.0,), (None,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in out] == [0, 0, 2, 0] and out[0].lo == 3.5


def test_skewness_is_corrected(spark):
    data = [1.0, 2.0, 2.5, 9.0, 30.0]
    got = A.distribution_summary(spark.createDataFrame([(v,) for v in data], "x double"), "x").first()["skewness"]
    n, m = len(data), statistics.fmean(data)
    g = sum((v - m) ** 3 for v in data) / n / (sum((v - m) ** 2 for v in data) / n) ** 1.5
    assert got == pytest.approx(g * math.sqrt(n * (n - 1)) / (n - 2))


def test_labels_never_true(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z"), ("b", "b"), ("b", "a")], "t string, p string")
    report = E.class_report(E.confusion_counts(df, "t", "p"))
    rows = {r.label: r for r in report.collect()}
    assert rows["z"].precision == 0 and rows["z"].recall == 0 and rows["z"].f1 == 0 and rows["z"].support == 0
    got = E.classification_metrics(report).first()
    assert got.accuracy == 0.5 and got.balanced_accuracy == pytest.approx(0.5)
    assert got.macro_f1 == pytest.approx((0.5 + 2 / 3 + 0) / 3) and got.weighted_f1 == pytest.approx((0.5 + 2 / 3) / 2)
    matrix = {r.truth: r for r in E.confusion_matrix(E.confusion_counts(df, "t", "p"), ["a", "b", "z"], normalized=True).collect()}
    assert matrix["a"].a == 50.0 and matrix["z"].z == 0.0


def test_label_sets(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, p string")
    counts = E.confusion_counts(df, "t", "p")
    rows = {r.label: r for r in E.class_report(counts, ["a", "b", "never"]).collect()}
    assert set(rows) == {"a", "b", "never"} and rows["never"].f1 == 0 and rows["a"].recall == 0.5
    grouped = E.class_report(counts.withColumn("g", F.lit(1)), ["a", "b", "never"], by=["g"])
    assert grouped.count() == 3 and E.classification_metrics(grouped, ["g"]).first().macro_f1 == pytest.approx((2 / 3 + 2 / 3 + 0) / 3)
    with pytest.raises(Exception, match="not a known label"):
        E.class_report(counts, ["a"]).collect()
    with pytest.raises(Exception, match="not a known label"):
        E.class_report(E.confusion_counts(spark.createDataFrame([("a", None)], "t string, p string"), "t", "p"), ["a"]).collect()


def test_regression_measures(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "y double, p double")
    got = E.regression_metrics(df, "y", "p").first()
    assert (got.mae, got.rmse, got.r2) == pytest.approx((4 / 3, math.sqrt(10 / 3), 1 - 10 / 8))


def test_verdicts(spark):
    df = spark.createDataFrame([(1.0, 0.9), (1.0, 1.04), (1.0, 1.08), (1.0, 1.2), (0.0, 1.0)], "c double, v double")
    out = df.withColumns(E.cv_gap(F.col("c"), F.col("v"))).collect()
    assert [r.verdict for r in out] == ["validation better", "very close", "moderate loss", "strong loss", "strong loss"]
    assert out[-1].gap_pct is None


def test_eta_squared(spark):
    from fleetprep.operators.association import eta_squared

    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 1.0), ("b", "x", 3.0), (None, "y", 99.0)], "g string, h string, y double")
    got = {r.variable: r.eta_squared for r in eta_squared(df.where("y < 50"), "y", ["g", "h"]).collect()}
    assert got["g"] == pytest.approx(1.0)
    flat = eta_squared(spark.createDataFrame([("a", 1.0), ("b", 1.0)], "g string, y double"), "y", ["g"]).first()
    assert flat.eta_squared == 0.0
