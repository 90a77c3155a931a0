"""Evaluation of a scored frame.

One grouped pass over the scored rows gives a table with one row per (label, prediction); all
metrics are computed from those few rows (nine for two classes and the unknown class).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import class_probability, ref, row_weight, share
from tallyframe.operators.quantiles import numeric_summary
from tallyframe.operators.summary import confidence_measures, weighted_rows
from tallyframe.sources.staging import run_folder, stage_parquet


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"scored frame lacks {missing}; it has {df.columns}")


def confusion_counts(
    scored: DataFrame,
    label_col: str = "label_indexed",
    prediction_col: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """Rows per (label_indexed, prediction); with ``weight``, a column's name, the sum of their weights."""
    require_columns(scored, label_col, prediction_col)
    n = F.count(F.lit(1)) if weight is None else F.sum(row_weight(weight))
    return (
        weighted_rows(scored, weight)
        .groupBy(ref(label_col).alias("label_indexed"), ref(prediction_col).alias("prediction"))
        .agg(n.alias("n"))
    )


def outcome_cells(
    scored: DataFrame,
    label_col: str = "label_indexed",
    prediction_col: str = "prediction",
    probability_col: str = "probability",
    weight: str | None = None,
) -> DataFrame:
    """Confusion counts and confidence measures of the same cells, in one pass, rows by weight if one is named.

    Input to every metric and summary function of the package.
    """
    require_columns(scored, label_col, prediction_col, probability_col)
    scored = weighted_rows(scored, weight)
    return scored.groupBy(
        ref(label_col).alias("label_indexed"), ref(prediction_col).alias("prediction")
    ).agg(*confidence_measures(scored, probability_col, weight))


def _cells(positive: float) -> dict[str, Column]:
    """The four named cells and the rest, as sums over confusion counts."""
    actual, predicted, n = F.col("label_indexed"), F.col("prediction"), F.col("n")
    negative = 1.0 - positive

    def cell(label: float, prediction: float) -> Column:
        return F.coalesce(F.sum(F.when((actual == label) & (predicted == prediction), n)), F.lit(0))

    named = {
        "tn": cell(negative, negative),
        "fp": cell(negative, positive),
        "fn": cell(positive, negative),
        "tp": cell(positive, positive),
    }
    rest = F.coalesce(F.sum("n"), F.lit(0)) - named["tn"] - named["fp"] - named["fn"] - named["tp"]
    return named | {"other": rest}


def confusion_matrix(confusion: DataFrame, positive: float = 1.0) -> DataFrame:
    """One row: tn, fp, fn, tp, and ``other`` for NULL or unknown-class labels and predictions.

    Longs, or doubles where rows were counted by weights that are no whole numbers.
    """
    kind = "long" if isinstance(confusion.schema["n"].dataType, T.IntegralType) else "double"
    return confusion.agg(*[e.cast(kind).alias(name) for name, e in _cells(positive).items()])


def binary_metrics(confusion: DataFrame, positive: float = 1.0) -> DataFrame:
    """Accuracy over all rows; precision, recall and F1 of the positive class, 0 if undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    hits = tp + F.col("tn")
    precision = F.coalesce(share(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(share(tp, tp + fn), F.lit(0.0))
    return (
        confusion_matrix(confusion, positive)
        .select(
            F.coalesce(share(hits, hits + fp + fn + F.col("other")), F.lit(0.0)).alias("accuracy"),
            precision.alias("positive_precision"),
            recall.alias("positive_recall"),
        )
        .withColumn("positive_f1", _f1(F.col("positive_precision"), F.col("positive_recall")))
    )


def _f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(share(2 * precision * recall, precision + recall), F.lit(0.0))


def weighted_metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged over the true classes by their share.

    Rows with a NULL label or prediction are left out; a class never predicted has precision 0.
    """
    known = confusion.where(F.col("label_indexed").isNotNull() & F.col("prediction").isNotNull())
    n, none = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("label_indexed") == F.col("prediction"), n).otherwise(none)

    def role(cls: str, actual: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(cls).alias("cls"), actual.alias("actual"), predicted.alias("predicted"), hits.alias("hits")
        )

    per_class = (
        known.select(
            F.inline(F.array(role("label_indexed", n, none, hit), role("prediction", none, n, none)))
        )
        .groupBy("cls")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .withColumn("precision", F.coalesce(share(F.col("hits"), F.col("predicted")), F.lit(0.0)))
        .withColumn("recall", F.coalesce(share(F.col("hits"), F.col("actual")), F.lit(0.0)))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )

    def weighted(metric: str) -> Column:
        return share(F.sum(F.col("actual") * F.col(metric)), F.sum("actual"))

    return per_class.agg(
        share(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
    )


def class1_probability_summary(
    scored: DataFrame, probability_col: str = "probability", weight: str | None = None
) -> DataFrame:
    """count, mean, stddev, min, exact quartiles and max of the probability of class 1, rows by whole weights if named.

    A probability vector of length one contributes its only entry. The probabilities are written once, as one
    column of doubles, so that the passes of the quantiles do not score the rows again.
    """
    require_columns(scored, probability_col)
    counted = [] if weight is None else [ref(weight).alias("weight")]
    p = scored.select(class_probability(scored, probability_col, 1).cast("double").alias("class1_probability"), *counted)
    staged = stage_parquet(p, run_folder(scored.sparkSession, "class1_probability"))
    return numeric_summary(staged, ["class1_probability"], weight=None if weight is None else "weight")
