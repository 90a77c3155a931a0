"""Prediction summaries: rows per predicted class, confidence statistics and bands.

All three read the cells of one grouped pass (:func:`confidence_cells`, or
``evaluation.outcome_cells`` where labels exist), a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import confidence, ref, row_weight, share
from tallyframe.operators.model import decoded

# Limits of the confidence bands (fixed values).
HIGH_CONFIDENCE = 0.8
MEDIUM_CONFIDENCE = 0.6


def confidence_measures(
    scored: DataFrame, probability_col: str = "probability", weight: str | None = None
) -> list[Column]:
    """Additive measures of row confidence: any grouping of them can be merged further.

    With ``weight``, the name of a column, a row counts as that many equal rows; rows of weight 0 belong out of
    the input (``weighted_rows``), as they would still count for the extremes.
    """
    c = confidence(scored, probability_col)
    if weight is not None:
        w = row_weight(weight)

        def within(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, w)), F.lit(0))

        return [
            F.sum(w).alias("n"),
            within(c.isNotNull()).alias("n_confidence"),
            F.sum(w * c).alias("confidence_sum"),
            F.min(c).alias("confidence_min"),
            F.max(c).alias("confidence_max"),
            within(c >= HIGH_CONFIDENCE).alias("n_high"),
            within((c >= MEDIUM_CONFIDENCE) & (c < HIGH_CONFIDENCE)).alias("n_medium"),
            within(c < MEDIUM_CONFIDENCE).alias("n_low"),
        ]
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(c).alias("n_confidence"),
        F.sum(c).alias("confidence_sum"),
        F.min(c).alias("confidence_min"),
        F.max(c).alias("confidence_max"),
        F.count_if(c >= HIGH_CONFIDENCE).alias("n_high"),
        F.count_if((c >= MEDIUM_CONFIDENCE) & (c < HIGH_CONFIDENCE)).alias("n_medium"),
        F.count_if(c < MEDIUM_CONFIDENCE).alias("n_low"),
    ]


def weighted_rows(df: DataFrame, weight: str | None) -> DataFrame:
    """The rows that count: all, or those of a weight above 0."""
    return df if weight is None else df.where(row_weight(weight) > 0)


def confidence_cells(
    scored: DataFrame, prediction_col: str = "prediction", probability_col: str = "probability", weight: str | None = None
) -> DataFrame:
    """Row count (or weight) and confidence measures per predicted class."""
    scored = weighted_rows(scored, weight)
    return scored.groupBy(ref(prediction_col).alias("prediction")).agg(
        *confidence_measures(scored, probability_col, weight)
    )


def prediction_summary(cells: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Rows and percent of all rows per predicted class, with its ``predicted_label`` if labels are given."""
    per_class = cells.groupBy("prediction").agg(F.sum("n").alias("count"))
    # The window spans one row per class of the model.
    total = F.sum("count").over(Window.partitionBy())
    label = [] if labels is None else [decoded(list(labels)).alias("predicted_label")]
    return per_class.select("prediction", "count", (100 * share(F.col("count"), total)).alias("percent"), *label)


def confidence_stats(cells: DataFrame) -> DataFrame:
    """Mean, min and max confidence over all rows."""
    return cells.agg(
        share(F.sum("confidence_sum"), F.sum("n_confidence")).alias("mean_confidence"),
        F.min("confidence_min").alias("min_confidence"),
        F.max("confidence_max").alias("max_confidence"),
    )


def confidence_bands(cells: DataFrame) -> DataFrame:
    """Rows and percent of all rows per band (high >= 0.8 > medium >= 0.6 > low), empty ones too."""
    bands = ("high", "medium", "low")
    totals = cells.agg(
        F.sum("n").alias("n"),
        *[F.coalesce(F.sum(f"n_{b}"), F.lit(0)).cast("long").alias(f"n_{b}") for b in bands],
    )
    rows = [
        F.struct(
            F.lit(b).alias("band"),
            F.col(f"n_{b}").alias("count"),
            (100 * share(F.col(f"n_{b}"), F.col("n"))).alias("percent"),
        )
        for b in bands
    ]
    return totals.select(F.inline(F.array(*rows)))
