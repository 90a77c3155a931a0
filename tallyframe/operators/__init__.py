"""Operators: functions from DataFrame to DataFrame, plus the model fit."""

from tallyframe.operators.evaluation import (
    binary_metrics,
    class1_probability_summary,
    confusion_counts,
    confusion_matrix,
    outcome_cells,
    weighted_metrics,
)
from tallyframe.operators.features import (
    assembler,
    category_counts,
    category_indexers,
    category_labels,
    index_counts,
    one_hot,
    slot_names,
    slot_totals,
)
from tallyframe.operators.folds import held_out_split, with_fold
from tallyframe.operators.model import (
    Classifier,
    ModelParams,
    build_pipeline,
    calibration,
    coefficient_table,
    decoded,
    fit_classifier,
    score,
)
from tallyframe.operators.model_store import load_model, save_model, versions
from tallyframe.operators.profiling import (
    category_cells,
    column_profile,
    crosstab,
    describe_numeric,
    describe_string,
    distinct_labels,
    head_rows,
    label_check,
    label_distribution,
    label_proportions,
    merged_profile,
    merged_states,
    missing_counts,
    profile_state,
    row_count,
    schema_listing,
)
from tallyframe.operators.quantiles import numeric_summary
from tallyframe.operators.ranking import roc_points, roc_summary
from tallyframe.operators.report import metrics_report, write_report
from tallyframe.operators.scoring import LinearModel, bulk_score, fit_optimality, linear_model, prediction_sample, scorable
from tallyframe.operators.summary import (
    confidence_bands,
    confidence_cells,
    confidence_stats,
    prediction_summary,
)
from tallyframe.operators.validation import candidate_ranking, cross_validation, fit_folds, fits_at_once

__all__ = [
    "Classifier",
    "LinearModel",
    "ModelParams",
    "assembler",
    "binary_metrics",
    "build_pipeline",
    "bulk_score",
    "calibration",
    "candidate_ranking",
    "category_cells",
    "category_counts",
    "category_indexers",
    "category_labels",
    "class1_probability_summary",
    "coefficient_table",
    "column_profile",
    "confidence_bands",
    "confidence_cells",
    "confidence_stats",
    "confusion_counts",
    "confusion_matrix",
    "cross_validation",
    "crosstab",
    "decoded",
    "describe_numeric",
    "describe_string",
    "distinct_labels",
    "fit_classifier",
    "fit_folds",
    "fit_optimality",
    "fits_at_once",
    "head_rows",
    "held_out_split",
    "index_counts",
    "label_check",
    "label_distribution",
    "label_proportions",
    "linear_model",
    "load_model",
    "merged_profile",
    "merged_states",
    "metrics_report",
    "missing_counts",
    "numeric_summary",
    "one_hot",
    "outcome_cells",
    "prediction_sample",
    "prediction_summary",
    "profile_state",
    "roc_points",
    "roc_summary",
    "row_count",
    "save_model",
    "schema_listing",
    "score",
    "slot_names",
    "slot_totals",
    "versions",
    "weighted_metrics",
    "with_fold",
    "write_report",
]
