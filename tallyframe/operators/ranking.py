"""How well a score ranks: the ROC curve, its exact area, average precision, and the largest distance of the classes.

Rows fold into counts per distinct score first, with map-side combine, so that ties are single rows however
many there are. The counts are ranged by score and added up (``running``); every figure is a sum or a maximum over
them. Rows without a label or a score, with a NaN score, or with a label that is neither class are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import class_probability, ref, share
from tallyframe.operators.evaluation import require_columns
from tallyframe.operators.running import with_running_totals


def roc_points(
    scored: DataFrame, label_col: str = "label_indexed", probability_col: str = "probability", positive: int = 1
) -> DataFrame:
    """threshold, positives, negatives (rows at that score), tp, fp (rows at that score or above); highest first.

    The score is the probability of class ``positive``; the other class is ``1 - positive``.
    """
    require_columns(scored, label_col, probability_col)
    score = class_probability(scored, probability_col, positive).cast("double")
    rows = scored.select(score.alias("threshold"), ref(label_col).alias("label"))
    known = rows.where(F.col("label").isin(float(positive), 1.0 - positive) & F.col("threshold").isNotNull() & ~F.isnan("threshold"))
    counted = known.groupBy("threshold").agg(
        F.count_if(F.col("label") == positive).alias("positives"), F.count_if(F.col("label") != positive).alias("negatives")
    )
    return with_running_totals(counted, [F.desc("threshold")], {"tp": "positives", "fp": "negatives"})


def roc_summary(points: DataFrame) -> DataFrame:
    """One row: n_positive, n_negative, auc, average_precision, ks, best_threshold.

    ``auc`` is the chance that a positive scores above a negative, ties counting half; its pairs are
    counted in decimals, exactly. ``ks`` is the largest distance between the shares of positives and of negatives at or above a
    threshold, ``best_threshold`` the highest threshold that has it. Without rows of both classes they are NULL.
    """
    # A negative loses to all positives above it and, by half, to those beside it.
    wide = "decimal(38, 0)"
    lost = F.col("negatives").cast("decimal(19, 0)") * (2 * F.col("tp") - F.col("positives")).cast("decimal(19, 0)")
    precision = share(F.col("tp"), F.col("tp") + F.col("fp"))
    totals = points.agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("n_positive"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("n_negative"),
        F.sum(lost.cast(wide)).alias("lost"),
        F.sum(F.col("positives") * precision).alias("precise"),
    )
    n, m, lost_pairs, precise = totals.first()
    if not n or not m:
        found = points.agg(F.lit(None).cast("double").alias("ks"), F.lit(None).cast("double").alias("best_threshold"))
    else:
        distance = F.col("tp") / F.lit(n) - F.col("fp") / F.lit(m)
        best = F.max(F.struct(F.abs(distance).alias("ks"), F.col("threshold").alias("best_threshold"))).alias("best")
        found = points.agg(best).select("best.*")
    auc = float(lost_pairs) / 2 / n / m if n and m else None
    return found.select(
        F.lit(n).cast("bigint").alias("n_positive"),
        F.lit(m).cast("bigint").alias("n_negative"),
        F.lit(auc).cast("double").alias("auc"),
        F.lit(precise / n if n and m else None).cast("double").alias("average_precision"),
        "ks",
        "best_threshold",
    )
