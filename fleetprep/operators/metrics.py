"""Regression and classification measures from a table of true and predicted values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetprep.functions.text import name
from fleetprep.functions.values import percent


def regression_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., rows, mae, rmse, r2) in one pass."""
    y, e = name(truth), name(truth) - name(predicted)
    squares = F.sum(e * e)
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(squares, F.var_pop(y) * F.count(y))).alias("r2"),
    )


def confusion_counts(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., truth, predicted, n): all that the class measures need, as small as the label set."""
    return df.groupBy(*by, name(truth).alias("truth"), name(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_report(counts: DataFrame, labels: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., label, precision, recall, f1, support, hits, rows) for every label of the set, or else for every one that is true or
    predicted somewhere. A ratio without denominator is 0. Missing labels, and those outside the set, are an error.
    """
    known = F.lit(True) if labels is None else F.col("label").isin(list(labels))
    if labels is not None:
        every = counts.select(*by).distinct() if by else counts.sparkSession.range(1).select()
        cells = [F.lit(v) for v in labels]
        every = every.select(*by, F.explode(F.array(*cells)).alias("truth")).select(*by, "truth", F.col("truth").alias("predicted"))
        counts = counts.unionByName(every.withColumn("n", F.lit(0).cast("bigint")))
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed"),
                 F.lit(0).cast("bigint").alias("hits")),
    )))
    unfit = F.raise_error(F.concat(F.lit("not a known label: "), F.coalesce(F.col("label").cast("string"), F.lit("missing"))))
    sides = sides.withColumn("label", F.when(F.col("label").isNotNull() & known, F.col("label")).otherwise(unfit.cast(sides.schema["label"].dataType)))
    totals = sides.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hits")])
    zero = F.lit(0.0)
    return totals.select(
        *by, "label",
        F.coalesce(F.try_divide(F.col("hits"), F.col("claimed")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("support")), zero).alias("recall"),
        F.coalesce(F.try_divide(F.lit(2.0) * F.col("hits"), F.col("support") + F.col("claimed")), zero).alias("f1"),
        "support", "hits",
    )


def classification_metrics(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., rows, accuracy, balanced_accuracy, macro_f1, weighted_f1) from class_report.

    Balanced accuracy is the mean recall over labels that truly occur; macro-F1 is the mean over all labels seen.
    """
    true_label = F.col("support") > 0
    return report.groupBy(*by).agg(
        F.sum("support").alias("rows"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg(F.when(true_label, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )


def evaluate_classes(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return classification_metrics(class_report(confusion_counts(df, truth, predicted, by), by=by), by)


def confusion_matrix(counts: DataFrame, labels: Sequence[str], normalized: bool = False) -> DataFrame:
    """One row per true label, one column per predicted label; all labels listed, rows as percentages on request."""
    cell = lambda v: F.coalesce(F.sum(F.when(F.col("predicted") == v, F.col("n"))), F.lit(0))
    wide = counts.groupBy("truth").agg(*[cell(v).alias(v) for v in labels])
    frame = counts.sparkSession.createDataFrame([(v,) for v in labels], "truth string")
    full = frame.join(wide, "truth", "left").fillna(0)
    if not normalized:
        return full
    total = sum((name(v) for v in labels), F.lit(0))
    return full.select("truth", *[percent(name(v), total).alias(v) for v in labels])


def with_gaps(metrics: DataFrame, errors: Sequence[str], scores: Sequence[str], model: str = "model", part: str = "part") -> DataFrame:
    """One row per model: every measure for train and validation, and the gap.

    An error's gap is validation minus train, a score's gap train minus validation, so a positive gap is always a loss.
    """
    def of(p: str, m: str) -> Column:
        return F.max(F.when(name(part) == p, name(m)))

    measures = [*errors, *scores]
    wide = metrics.groupBy(model).agg(*[of(p, m).alias(f"{m}_{p}") for m in measures for p in ("train", "validation")])
    gaps = {f"{m}_gap": name(f"{m}_validation") - name(f"{m}_train") for m in errors}
    gaps |= {f"{m}_gap": name(f"{m}_train") - name(f"{m}_validation") for m in scores}
    return wide.withColumns(gaps)


def cv_gap(cv_score: Column, validation_score: Column) -> dict[str, Column]:
    """Gap between cross-validation and validation error: absolute, in percent, and a verdict."""
    gap = validation_score - cv_score
    pct = F.try_divide(F.abs(gap) * 100, F.abs(cv_score))
    verdict = (
        F.when(gap < 0, "validation better").when(pct <= 5, "very close").when(pct <= 10, "moderate loss").otherwise("strong loss")
    )
    return {"gap": gap, "gap_abs": F.abs(gap), "gap_pct": pct, "verdict": verdict}


def leakage_checks(
    columns_by_part: Mapping[str, Sequence[str]], forbidden: Sequence[str], keywords: Sequence[str]
) -> dict[str, bool]:
    """Named results: no forbidden column, no column whose name holds a target keyword, same columns in every part."""
    lists = list(columns_by_part.values())
    every = {c for cols in lists for c in cols}
    lower = {c.lower() for c in every}
    out = {f"forbidden:{f}": all(f.lower() != c for c in lower) for f in forbidden}
    out |= {f"keyword:{k}": all(k.lower() not in c for c in lower) for k in keywords}
    out["same_columns"] = all(list(cols) == list(lists[0]) for cols in lists)
    return out
