"""The metrics report as a long table, and its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import share
from tallyframe.operators.evaluation import binary_metrics, confusion_matrix


def metrics_report(confusion: DataFrame, positive: float = 1.0) -> DataFrame:
    """``(section, name, value)``: the four metrics to 4 decimals and the four matrix cells.

    Empty when nothing was scored.
    """
    matrix = confusion_matrix(confusion, positive)
    counts = matrix.select(F.struct("*").alias("m"), (sum(F.col(c) for c in matrix.columns)).alias("n_rows"))
    tn, fp, fn, tp = (F.col(f"m.{c}") for c in ("tn", "fp", "fn", "tp"))
    precision = F.coalesce(share(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(share(tp, tp + fn), F.lit(0.0))
    entries = {
        ("metrics", "precision"): F.round(precision, 4),
        ("metrics", "recall"): F.round(recall, 4),
        ("metrics", "f1_score"): F.round(F.coalesce(share(2 * tp, 2 * tp + fp + fn), F.lit(0.0)), 4),
        ("metrics", "accuracy"): F.round(share(tp + tn, F.col("n_rows")), 4),
        ("confusion_matrix", "tn"): tn,
        ("confusion_matrix", "fp"): fp,
        ("confusion_matrix", "fn"): fn,
        ("confusion_matrix", "tp"): tp,
    }
    return counts.where("n_rows > 0").select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), v.cast("double").alias("value"))
                    for (s, n), v in entries.items()
                ]
            )
        )
    )


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write a metrics report (parquet or csv) over an earlier one; False if it has no rows.

    An empty report is written too, so that no earlier one stays to be read as current.
    """
    report.coalesce(1).write.mode("overwrite").format(fmt).options(header=True).save(path)
    return not report.sparkSession.read.schema(report.schema).format(fmt).options(header=True).load(path).isEmpty()
