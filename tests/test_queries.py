"""Every query against its SQL twin on the small tables; those without one give rows."""

import pytest
from conftest import SMALL
from oracle import compare, connect

from __spark_entry__ import entry
from catalogue import all_queries

MODELS = ["ridge_regression", "tuning_report", "final_test_per_class"]




def queries():
    return {label: q.run for label, q in all_queries().items()}


def oracle_sql():
    return {label: q.oracle for label, q in all_queries().items() if q.oracle}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("label", sorted(oracle_sql()))
def test_equals_sql(spark, duck, label):
    assert compare(spark, duck, SMALL, queries()[label], oracle_sql()[label]) is None


@pytest.mark.parametrize("label", MODELS)
def test_has_rows(spark, label):
    assert queries()[label](spark, SMALL).count() > 0


def test_entry(spark):
    assert [r["class"] for r in entry(spark).orderBy("class").collect()] == list("ABCDEFG")


def test_only_fitted_models_lack_sql():
    without = set(queries()) - set(oracle_sql())
    assert without == {
        "ridge_regression", "rf_regression", "gbt_regression", "logistic_classification", "rf_classification", "gbt_classification",
        "eval_regression", "eval_classification", "random_search", "tuning_report", "final_test_regression", "final_test_classification", "final_test_per_class",
    }
