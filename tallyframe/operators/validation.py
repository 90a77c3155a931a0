"""Cross-validation: one staged table with a fold column, a fit for every candidate and fold, one pass to judge each.

Fits run side by side, as many as fit memory: a fit keeps its standardized rows in the executors' storage
(``fits_at_once``). Large tables are dealt out into parts once for all fits. What comes back from a fit is its weights, and from judging it a few counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.functions import ref, row_weight, share
from tallyframe.operators.evaluation import binary_metrics
from tallyframe.operators.model import Classifier, ModelParams, dealt, fit_classifier, training_columns
from tallyframe.operators.scoring import bulk_score, linear_model
from tallyframe.operators.summary import weighted_rows

#: The share of the free storage memory that the rows of all running fits may take.
MEMORY_SHARE = 0.5

_RESULT = (
    "candidate int, fold int, n_rows bigint, log_loss double, accuracy double, "
    "positive_precision double, positive_recall double, positive_f1 double"
)


def free_storage(spark: SparkSession) -> int:
    """Bytes of storage memory that no cached block takes, over all executors."""
    held = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    free = 0
    while held.hasNext():
        free += int(held.next()._2())
    return free


def fits_at_once(n_rows: int, n_slots: int, free_bytes: int) -> int:
    """How many fits may run side by side: a row takes a double per slot, its label and its weight."""
    return max(1, int(free_bytes * MEMORY_SHARE) // max(1, n_rows * (n_slots + 2) * 8))


def fold_numbers(rows: DataFrame, fold_col: str = "fold") -> list[int]:
    return sorted(r[0] for r in rows.select(ref(fold_col)).distinct().collect())


def without_fold(rows: DataFrame, fold: int, fold_col: str = "fold") -> DataFrame:
    return rows.where(ref(fold_col) != fold).drop(fold_col)


def fit_folds(
    rows: DataFrame, candidates: Sequence[ModelParams], fold_col: str = "fold", at_once: int | None = None
) -> dict[tuple[int, int], Classifier]:
    """For each candidate (by position) and fold the classifier fitted on all other folds."""
    tasks = [(k, fold) for k in range(len(candidates)) for fold in fold_numbers(rows, fold_col)]

    if not tasks:
        return {}
    n_rows = rows.count()
    names = dict.fromkeys([*[c for p in candidates for c in training_columns(p)], fold_col])
    used = rows.select(*[ref(c) for c in names])
    parts = dealt(used, max(candidates, key=lambda p: len(p.numeric_cols) + len(p.categorical_cols)), n_rows)
    in_parts = parts is not used

    def fit(task: tuple[int, int]) -> Classifier:
        return fit_classifier(without_fold(parts, task[1], fold_col), candidates[task[0]], in_parts)

    if in_parts:
        parts.persist(StorageLevel.DISK_ONLY)
    try:
        # The first fit tells how many slots the rows have.
        first = fit(tasks[0])
        if at_once is None:
            at_once = fits_at_once(n_rows, len(linear_model(first).slots), free_storage(rows.sparkSession))
        with ThreadPool(max(1, min(at_once, len(tasks)))) as pool:
            rest = pool.map(inheritable_thread_target(rows.sparkSession)(fit), tasks[1:], chunksize=1)
    finally:
        if in_parts:
            parts.unpersist()
    return dict(zip(tasks, [first, *rest]))


def judged(classifier: Classifier, held_out: DataFrame) -> tuple:
    """n_rows, log_loss, accuracy, positive precision, recall and F1 on rows with a label, in one pass.

    With a ``weight_col`` all but n_rows count a row as that many equal ones.
    """
    label, weight = classifier.params.label_col, classifier.params.weight_col
    scored = bulk_score(classifier, weighted_rows(held_out.where(ref(label).isNotNull()), weight))
    w = F.lit(1) if weight is None else row_weight(weight)
    known = F.get("probability", F.col(f"`{label}_indexed`").cast("int"))
    cells = scored.groupBy(F.col(f"`{label}_indexed`").alias("label_indexed"), "prediction").agg(
        F.sum(w).alias("n"), F.sum(-F.log(known) * w).alias("loss"), F.count(F.lit(1)).alias("n_rows")
    )
    few = cells.collect()
    n = sum(r["n"] for r in few)
    kind = cells.schema["n"].dataType.simpleString()
    table = held_out.sparkSession.createDataFrame([tuple(r)[:3] for r in few], f"label_indexed double, prediction double, n {kind}")
    metrics = binary_metrics(table, classifier.positive_index).first()
    return (sum(r["n_rows"] for r in few), sum(r["loss"] for r in few) / n if n else None, *metrics)


def cross_validation(
    rows: DataFrame, candidates: Sequence[ModelParams], fold_col: str = "fold", at_once: int | None = None
) -> DataFrame:
    """A row for each candidate (its position) and fold: the candidate fitted without the fold, judged on it."""
    fits = fit_folds(rows, candidates, fold_col, at_once)
    found = [
        (k, fold, *judged(classifier, rows.where(ref(fold_col) == fold).drop(fold_col))) for (k, fold), classifier in fits.items()
    ]
    return rows.sparkSession.createDataFrame(found, _RESULT)


def candidate_ranking(results: DataFrame, metric: str = "log_loss", largest: bool = False) -> DataFrame:
    """candidate, n_folds, mean and sample deviation of the metric over its folds, and rank: 1 is best, ties by position."""
    folds = results.groupBy("candidate").agg(
        F.count(F.lit(1)).alias("n_folds"),
        share(F.sum(ref(metric)), F.count(ref(metric))).alias("mean"),
        F.stddev_samp(ref(metric)).alias("deviation"),
    )
    best = F.col("mean").desc_nulls_last() if largest else F.col("mean").asc_nulls_last()
    return folds.withColumn("rank", F.row_number().over(Window.orderBy(best, "candidate")))
