import pytest
from pyspark.sql import functions as F

from fleetprep import contracts as K
from fleetprep.functions import text as X
from fleetprep.functions import values as V


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def results(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_strip_removes_all_blanks_and_keeps_missing(spark):
    df = column(spark, ["\t a ", "", "  ", None, " b ", "c\n", "d e"])
    assert results(df, X.strip(F.col("x"))) == ["a", "", "", None, "b", "c", "d e"]


def test_comparison_key_joins_spellings(spark):
    df = column(spark, ["MERCEDES-BENZ", "Mercedes Benz", "MERCEDES - BENZ", " mercedes_/.benz ", None])
    assert results(df, X.comparison_key(F.col("x"))) == ["MERCEDES BENZ"] * 4 + [None]


def test_digits(spark):
    df = column(spark, ["12", " 12 ", "12a", "", None, "1\n2", "１２"])
    assert results(df, X.is_digits(F.col("x"))) == [True, True, False, False, False, False, True]


def test_code_like(spark):
    df = column(spark, ["A1", "1-2", "12", "AB", "a-b", "", "x*9"])
    assert results(df, X.is_code_like(F.col("x"))) == [True, True, False, False, False, False, True]


def test_classes_are_closed_on_the_right(spark):
    df = column(spark, [0.0, 100.0, 100.01, 120.0, 140.0, 160.0, 200.0, 250.0, 250.5, None, float("nan")], "double")
    got = results(df, V.right_closed_class(F.col("x"), K.CLASS_BOUNDS, K.CLASS_LABELS))
    assert got == ["A", "A", "B", "B", "C", "D", "E", "F", "G", None, None]


def test_class_arguments_are_checked():
    with pytest.raises(ValueError):
        V.right_closed_class(F.lit(1.0), [1.0], ["a"])
    with pytest.raises(ValueError):
        V.right_closed_class(F.lit(1.0), [2.0, 1.0], ["a", "b", "c"])


def test_bins_hold_both_ends(spark):
    df = column(spark, [0.0, 1.0, 1.5, 3.0, 3.1, -0.1, None], "double")
    assert results(df, V.right_closed_bin(F.col("x"), [0.0, 1.0, 2.0, 3.0])) == [1, 1, 2, 3, None, None, None]


def test_bounds_as_text(spark):
    df = column(spark, ["-inf", "100.0", "inf", "bad", None])
    assert results(df, V.parse_bound(F.col("x"))) == [float("-inf"), 100.0, float("inf"), None, None]


def test_membership_of_missing_is_false(spark):
    df = column(spark, ["a", "b", None])
    assert results(df, ~V.member(F.col("x"), ["a"])) == [False, True, True]


def test_month_angle(spark):
    df = column(spark, ["2024-01-15", "2024-04-01", "2024-07-31"]).withColumn("x", F.col("x").cast("timestamp"))
    assert [round(v, 9) for v in results(df, F.sin(V.month_angle(F.col("x"))))] == [0.0, 1.0, 0.0]


def test_dates(spark):
    df = column(spark, ["2024-02-30", "2024-02-29", "2024-02-29 10:11:12", "29/02/2024", "", None])
    got = results(df, V.parse_timestamp(F.col("x")))
    assert [g is not None for g in got] == [False, True, True, False, False, False]


def test_infinite(spark):
    df = column(spark, [float("inf"), float("-inf"), float("nan"), None, 1.0], "double")
    assert results(df, V.is_infinite(F.col("x"))) == [True, True, False, False, False]
