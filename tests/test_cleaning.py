import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetprep import contracts as K
from fleetprep.operators import makes as M
from fleetprep.operators import profile as A
from fleetprep.operators import schema as S
from fleetprep.operators.checks import enforce


def test_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(1, "a", None, None, 1.0), (2, "a", "x", None, 1.0)], "id int, c string, d string, e string, f double")
    assert S.empty_columns(df) == ["e"]
    assert S.constant_columns(df) == ["c", "e", "f"]  # d holds a value and a gap: two values
    kept, constant = S.drop_constant_columns(df, protected=["c"])
    assert kept.columns == ["id", "c", "d"] and constant == ["c", "e", "f"]
    assert S.drop_constant_columns(df, drop=False)[0].columns == df.columns


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, c string")
    assert [r.x for r in S.nan_free(df).collect()] == [None, 1.0]


def test_late_values_are_found_behind_the_probe(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") == 4999, F.lit("x")).alias("late"), F.lit(1).alias("one"))
    assert S.empty_columns(df) == []
    assert S.constant_columns(df) == ["one"]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` ID ` int, `Ewltp (g/km)` int, other int")
    assert S.normalize_column_names(df, K.SOURCE_NAMES).columns == ["vehicle_record_id", "co2_wltp_g_km", "other"]


def test_absent_date_column(spark):
    with pytest.raises(KeyError):
        S.parse_date_column(spark.range(1), "registration_date")


def test_contract_selection(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "k int, b int, a int, z int")
    assert S.select_contract(df, ["z"], ["a", "b"], keep=["k"]).columns == ["k", "b", "a"]
    with pytest.raises(ValueError, match="c"):
        S.select_contract(df, [], ["a", "c"])
    with pytest.raises(ValueError, match="a"):
        S.select_contract(df, ["a"], ["a"])


def test_unknown_rule(spark):
    with pytest.raises(ValueError, match="lower"):
        M.normalize_text(spark.createDataFrame([("a",)], "c string"), rules={"c": "lower"})


MAKES = [
    ("MERCEDES-BENZ", "eu1", "oem1"), ("Mercedes Benz", "eu1", "oem1"), ("Mercedes Benz", " EU1", "oem1"), ("MERCEDES - BENZ", "eu1", "oem1"),
    ("12", "Eu1 ", "OEM1"), (" 34 ", "eu9", "oem9"), ("56", None, "oem1"), (None, "eu1", "oem1"), ("Aa", "eu2", "oem2"), ("AA", "eu2", "oem2"),
]


def makes(spark):
    return spark.createDataFrame([(i, *m) for i, m in enumerate(MAKES)], "id int, manufacturer_make string, manufacturer_name_eu string, manufacturer_name_oem string")


def test_makes(spark):
    rows, report = M.normalize_make(makes(spark), K.MAKE, K.MAKER_EU, K.MAKER_OEM, 0.95)
    got = [r[K.MAKE] for r in rows.orderBy("id").collect()]
    assert got == ["Mercedes Benz"] * 4 + ["Mercedes Benz", None, None, None, "AA", "AA"]
    assert report.first().asDict() == {
        "numeric_before": 3, "numeric_resolved": 1, "typographic_keys": 2, "reliable_manufacturer_pairs": 2, "numeric_unresolved": 2,
        "resolution_threshold": 0.95,
    }


def test_makes_are_stable_when_cleaned_twice(spark):
    once, _ = M.normalize_make(makes(spark), K.MAKE, K.MAKER_EU, K.MAKER_OEM, 0.95)
    twice, report = M.normalize_make(once, K.MAKE, K.MAKER_EU, K.MAKER_OEM, 0.95)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert report.first()["numeric_before"] == 0


def test_make_arguments(spark):
    for share in (0, 1.01, -1):
        with pytest.raises(ValueError):
            M.normalize_make(makes(spark), K.MAKE, K.MAKER_EU, K.MAKER_OEM, share)
    with pytest.raises(ValueError):
        M.normalize_make(makes(spark).drop(K.MAKER_EU), K.MAKE, K.MAKER_EU, K.MAKER_OEM, 0.9)


def test_unreliable_pair_leaves_number_missing(spark):
    rows = [("A", "e", "o")] * 3 + [("B", "e", "o")] + [("7", "e", "o")]
    df = spark.createDataFrame(rows, "manufacturer_make string, manufacturer_name_eu string, manufacturer_name_oem string")
    assert M.normalize_make(df, K.MAKE, K.MAKER_EU, K.MAKER_OEM, 0.95)[0].where(F.col(K.MAKE).isNull()).count() == 1
    assert M.normalize_make(df, K.MAKE, K.MAKER_EU, K.MAKER_OEM, 0.75)[0].where(F.col(K.MAKE) == "A").count() == 4


def test_aliases(spark):
    df = spark.createDataFrame([(" volkswagen vw ",), ("VW",), (None,)], "manufacturer_make string")
    assert [r[0] for r in M.apply_aliases(df, K.MAKE, K.MAKE_ALIASES).collect()] == ["VOLKSWAGEN", "VW", None]
    assert M.alias_counts(df, K.MAKE, K.MAKE_ALIASES).first()["replaced"] == 1
    with pytest.raises(KeyError):
        M.apply_aliases(spark.range(1), K.MAKE, K.MAKE_ALIASES)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_lookups_by_shuffle_or_broadcast(spark, threshold):
    """A brand that holds a third of the rows, missing makes and missing maker pairs, joined either way."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "Hot").when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 7 == 0, "12").otherwise(F.concat(F.lit("k "), F.col("id") % 700)).alias(K.MAKE),
        F.when(F.col("id") % 11 > 0, F.lit("m")).alias(K.MAKER_EU), F.lit("o").alias(K.MAKER_OEM),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows, report = M.normalize_make(df, K.MAKE, K.MAKER_EU, K.MAKER_OEM, 0.3)
        counts = {r[0]: r[1] for r in rows.groupBy(K.MAKE).count().collect()}
        report = report.first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    numeric = [k for k in range(3000) if k % 3 and k % 10 and k % 7 == 0]
    resolved = [k for k in numeric if k % 11]
    assert (report["numeric_before"], report["numeric_resolved"]) == (len(numeric), len(resolved))
    assert sum(counts.values()) == 3000 and counts["Hot"] == 1000 + len(resolved)
    assert counts[None] == len([k for k in range(3000) if k % 3 and k % 10 == 0]) + len(numeric) - len(resolved)


def test_duplicates_treat_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, None), (1, None)], "a int, b string")
    assert A.duplicate_rows(df).first().asDict() == {"rows": 5, "duplicated": 2, "duplicated_pct": 40.0}


def test_duplicates_with_many_repeated_hashes(spark):
    df = spark.range(400).select((F.col("id") % 100).alias("a"), F.lit(None).cast("string").alias("b"))
    assert A.duplicate_rows(df).first()["duplicated"] == 300


def test_group_lookup_of_an_absent_group(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", None), (None, None)], "fuel_type string, x double")
    report = A.missing_by_group_long(df, "fuel_type", ["x"])
    assert A.missing_pct_of(report, "fuel_type", "p", "x") == 50.0
    assert A.missing_pct_of(report, "fuel_type", "q", "x") is None


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "x double")
    assert A.distinct_report(df, count_missing=True).first()["distinct_values"] == 2


def test_checks_name_what_failed(spark):
    from fleetprep.plans.cleaning import checks

    df = spark.createDataFrame([(1, "a")], "vehicle_record_id int, fuel_mode string")
    with pytest.raises(ValueError, match="date_is_timestamp.*required_columns.*upper_case:fuel_mode"):
        enforce(checks(df))


def test_date_type_is_required(spark):
    from fleetprep.plans.features import require_input

    schema = T.StructType([T.StructField(c, T.StringType()) for c in K.FEATURE_REQUIRED])
    with pytest.raises(TypeError):
        require_input(spark.createDataFrame([], schema))


def test_month_is_required(spark):
    from fleetprep.plans.features import temporal_features

    df = spark.createDataFrame([("x",)], "d string").withColumn("d", F.lit(None).cast("timestamp"))
    with pytest.raises(ValueError):
        temporal_features(df, "d")
