
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe import operators as op
from tallyframe import sources as src
from tallyframe.functions import class_probability, confidence, ref
from tallyframe.plans import score_file

try:  # the operators of this package and their pipeline are optional
    import corpus_pipeline
    from tallyframe.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

NUMERIC = ["age", "fnlwgt", "hours_per_week"]
CATEGORICAL = ["sex", "workclass", "education"]
LABELS = {"<=50K": "le_50k", ">50K": "gt_50k"}

Query = Callable[[SparkSession, str], DataFrame]

# A three-class model of our own; category values that the data has are missing from its lists.
FIXED = op.LinearModel(
    op.ModelParams(numeric_handle_invalid="skip"),
    {
        "sex": ["O", "F"],
        "workclass": ["N", "A"],
        "education": ["PROMO", "STANDARD", "ECONOMY"],
        "label": [">50K", "<=50K"],
    },
    [
        [0.02, 0.00007, -0.01, 0.3, -0.2, 0.1, 0.4, 0.25, -0.15, 0.05],
        [-0.01, -0.00006, 0.02, -0.1, 0.2, 0.15, -0.3, -0.25, 0.35, 0.1],
        [0.005, 0.00001, -0.03, 0.05, 0.05, -0.4, 0.2, 0.1, 0.1, -0.5],
    ],
    [-3.0, 2.5, -0.5],
)

_staged: dict[tuple[str, ...], str] = {}
_fitted: dict[tuple, op.Classifier] = {}

TWO_CLASSES = op.ModelParams(label_handle_invalid="error")
HELD_OUT, FOLDS = 0.2, 3
CANDIDATES = [TWO_CLASSES, op.ModelParams(label_handle_invalid="error", reg_param=0.1)]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the double columns, so that engines may differ in the last bits."""
    return df.select(
        *[
            F.round(ref(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else ref(f.name)
            for f in df.schema.fields
        ]
    )


def training_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The people of a data folder as a staged table, joined and written once per application.

    A fit reads its rows several times, and so does every query that scores them.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        path = src.run_folder(spark, "people")
        src.stage_parquet(src.people(spark, sf_dir, for_training=True), path)
        _staged[key] = path
    return spark.read.schema(src.LABELLED_SCHEMA).parquet(_staged[key])


def fitted(spark: SparkSession, sf_dir: str, params: op.ModelParams = op.ModelParams()) -> op.Classifier:
    """The classifier of a data folder, fitted once per application and parameters."""
    key = (spark.sparkContext.applicationId, sf_dir, params)
    if key not in _fitted:
        _fitted[key] = op.fit_classifier(training_people(spark, sf_dir), params)
    return _fitted[key]


def folded_people(spark: SparkSession, sf_dir: str, n_folds: int) -> DataFrame:
    """The training people with a fold of equal class shares, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, f"{n_folds} folds")
    rows = op.with_fold(training_people(spark, sf_dir), "label", [1 / n_folds] * n_folds)
    if key not in _staged:
        path = src.run_folder(spark, "folds")
        src.stage_parquet(rows, path)
        _staged[key] = path
    return spark.read.schema(rows.schema).parquet(_staged[key])


def held_out(spark: SparkSession, sf_dir: str) -> tuple[op.Classifier, DataFrame]:
    """The two-class classifier of four fifths of the people, and the fifth it has not seen."""
    training, rest = op.held_out_split(training_people(spark, sf_dir), "label", HELD_OUT)
    key = (spark.sparkContext.applicationId, sf_dir, "held out")
    if key not in _fitted:
        _fitted[key] = op.fit_classifier(training, TWO_CLASSES)
    return _fitted[key], rest


def release_staged(spark: SparkSession) -> None:
    """Delete the staged people tables of this application and forget what was fitted on them."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _staged if k[0] == app]:
        src.release(spark, _staged.pop(key))
    for key in [k for k in _fitted if k[0] == app]:
        del _fitted[key]


def scored_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.bulk_score(fitted(spark, sf_dir), training_people(spark, sf_dir))


def stage_scored_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.score(fitted(spark, sf_dir), training_people(spark, sf_dir))


def frozen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.frozen_scores(src.people(spark, sf_dir, ["age", "workclass", "fnlwgt", "label"]))


def frozen_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.outcome_cells(frozen(spark, sf_dir))


# --- sources and sinks


def typed_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = src.run_folder(spark, "typed_csv_scan")
    return src.read_labelled(spark, src.stage_csv(src.people_nulls(spark, sf_dir), folder))


def scoring_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = src.run_folder(spark, "scoring_scan")
    unlabelled = src.people_nulls(spark, sf_dir, src.FEATURE_SCHEMA.names)
    return src.read_unlabelled(spark, src.stage_csv(unlabelled, folder))


def _faulty_csv(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """People as lines of text with a fault by line number, read back: all rows, and those that did not parse."""
    rows = src.read_table(spark, sf_dir, "lineitem").selectExpr(
        """concat_ws(',', CASE l_linenumber WHEN 2 THEN '3x' WHEN 3 THEN '30.5' WHEN 4 THEN 'NaN' ELSE cast(cast(l_quantity AS int) AS string) END,
        l_linestatus, l_returnflag, CASE l_linenumber WHEN 3 THEN '99999999999' ELSE cast(floor(l_extendedprice) AS string) END,
        '"a, b"', '', CASE WHEN l_linenumber <> 5 THEN '>50K' END, CASE WHEN l_linenumber = 6 THEN 'one more' END) AS line"""
    )
    folder = src.run_folder(spark, name)
    rows.write.text(f"{folder}/text")
    return src.read_checked(spark, f"{folder}/text", src.LABELLED_SCHEMA, f"{folder}/rows", header=False)


def csv_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.fault_counts(_faulty_csv(spark, sf_dir, "csv_faults")[1])


def checked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with faults stay, with NULL where a field could not be read or was not there."""
    return _faulty_csv(spark, sf_dir, "checked_rows")[0]


def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = op.metrics_report(frozen_cells(spark, sf_dir))
    folder = src.run_folder(spark, "metrics_report")
    op.write_report(report, folder)
    return spark.read.schema(report.schema).parquet(folder)


# --- profiling


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.row_count(src.people(spark, sf_dir, ["sex"]))


def schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.schema_listing(src.people_nulls(spark, sf_dir))


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.head_rows(src.people(spark, sf_dir))


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.describe_numeric(src.people_nulls(spark, sf_dir, NUMERIC), NUMERIC), 4)


def describe_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*CATEGORICAL, "label"]
    return op.describe_string(src.people_nulls(spark, sf_dir, columns), columns)


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.people_nulls(spark, sf_dir)
    return rounded(op.column_profile(rows, NUMERIC, [*CATEGORICAL, "label"]), 4)


def missing_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["age_or_nan", *NUMERIC]
    return op.missing_counts(src.people_nulls(spark, sf_dir, columns), columns)


def missing_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*CATEGORICAL, "label"]
    return op.missing_counts(src.people_nulls(spark, sf_dir, columns), columns)


def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_labels(src.people_nulls(spark, sf_dir, ["label"]), "label")


def label_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.label_check(src.people(spark, sf_dir, ["label"]), "label")


def label_check_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.label_check(src.people_nulls(spark, sf_dir, ["label"]), "label")


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.label_distribution(src.people_nulls(spark, sf_dir, ["label"]), "label")


def label_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.label_proportions(src.people_nulls(spark, sf_dir, ["label"]), "label", list(LABELS)))


def crosstab(key: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op.crosstab(src.people_nulls(spark, sf_dir, [key, "label"]), key, "label", LABELS)

    return run


def category_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.category_cells(src.people_nulls(spark, sf_dir, [*CATEGORICAL, "label"]), CATEGORICAL, "label")


def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.numeric_summary(src.people(spark, sf_dir, NUMERIC), NUMERIC), 4)


def numeric_summary_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["age_or_nan", "age"]
    return rounded(op.numeric_summary(src.people_nulls(spark, sf_dir, columns), columns), 4)


def numeric_summary_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles with so low a limit on ranking that every column is narrowed first."""
    rows = src.read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_extendedprice", "l_extendedprice * l_discount AS rebate", "ln(l_extendedprice) * 1e-3 AS scaled"
    )
    return rounded(op.numeric_summary(rows, rows.columns, direct_values=500), 4)


def with_copies(people: DataFrame) -> DataFrame:
    """People who stand for 0 to 3 equal rows each."""
    return people.withColumn("copies", F.expr("hours_per_week % 4"))


def numeric_summary_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of the rows that the weights stand for, narrowed as columns of many values are."""
    rows = with_copies(src.people(spark, sf_dir, NUMERIC))
    return rounded(op.numeric_summary(rows, NUMERIC, direct_values=500, weight="copies"), 4)


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column profile put together from the written states of the parts that the rows come in."""
    rows = src.people_nulls(spark, sf_dir)
    parts = [rows.where("sex = 'O'"), rows.where("sex = 'F' AND age < 20"), rows.where("sex IS NULL OR sex NOT IN ('O', 'F')")]
    parts.append(rows.where("sex = 'F' AND (age >= 20 OR age IS NULL)"))
    folder = src.run_folder(spark, "profile_states")
    for k, part in enumerate(parts):
        op.profile_state(part, NUMERIC, [*CATEGORICAL, "label"]).write.parquet(f"{folder}/part={k}")
    return rounded(op.merged_profile(spark.read.parquet(folder).drop("part")), 4)


# --- features


def index_of(column: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = src.people_nulls(spark, sf_dir, [column])
        (indexer,) = op.category_indexers(op.category_labels(rows, [column]))
        return op.index_counts(indexer.transform(rows), column)

    return run


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.people(spark, sf_dir, [*NUMERIC, *CATEGORICAL])
    labels = op.category_labels(rows, CATEGORICAL)
    stages = [*op.category_indexers(labels), op.one_hot(CATEGORICAL), op.assembler(NUMERIC, CATEGORICAL)]
    return Pipeline(stages=stages).fit(rows).transform(rows)


def one_hot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.people_nulls(spark, sf_dir, CATEGORICAL)
    stages = [*op.category_indexers(op.category_labels(rows, CATEGORICAL)), op.one_hot(CATEGORICAL)]
    hot = Pipeline(stages=stages).fit(rows).transform(rows)
    # All three vectors side by side, summed as one: still a single pass.
    joined = op.assembler([], CATEGORICAL).transform(hot)
    return op.slot_totals(joined).select("slot", "feature", F.col("exact_total").cast("long").alias("n"))


def feature_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = op.slot_totals(_assembled(spark, sf_dir))
    return totals.select("slot", "feature", F.col("exact_total").cast("long").alias("total"), "non_zero")


# --- model


def model_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = stage_scored_people(spark, sf_dir)
    return rounded(op.coefficient_table(spark, fitted(spark, sf_dir), op.slot_names(scored)))


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.calibration(fitted(spark, sf_dir), scored_people(spark, sf_dir)), 3)


def _scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        *src.PEOPLE_COLUMNS,
        "label_indexed",
        "prediction",
        F.round(confidence(scored), 6).alias("confidence"),
    )


def score_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(scored_people(spark, sf_dir))


def score_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(stage_scored_people(spark, sf_dir))


def prediction_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.prediction_sample(fitted(spark, sf_dir), training_people(spark, sf_dir), hidden=["fnlwgt"])


def score_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All people without their label, some with an unknown workclass, read from a CSV."""
    unlabelled = src.people(spark, sf_dir, src.FEATURE_SCHEMA.names).withColumn(
        "workclass", F.expr("nullif(workclass, 'N')")
    )
    path = src.stage_csv(unlabelled, src.run_folder(spark, "score_new"))
    return score_file(fitted(spark, sf_dir), src.read_unlabelled(spark, path))


def train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, score the training rows, and report: the whole model path."""
    classifier = fitted(spark, sf_dir)
    return op.metrics_report(op.confusion_counts(scored_people(spark, sf_dir)), classifier.positive_index)


def fit_optimality(handling: str, tolerance: float) -> Query:
    """Whether every coefficient of the fit satisfies its optimality condition on the training rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        classifier = fitted(spark, sf_dir, op.ModelParams(label_handle_invalid=handling))
        return op.fit_optimality(classifier, training_people(spark, sf_dir), tolerance)

    return run


def fit_optimality_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a fit with weights, on the rows that the weights stand for, made by repeating them."""
    params = op.ModelParams(label_handle_invalid="error", weight_col="copies")
    people = with_copies(training_people(spark, sf_dir))
    classifier = op.fit_classifier(people, params)
    plain = op.LinearModel(TWO_CLASSES, **{k: getattr(op.linear_model(classifier), k) for k in ("category_labels", "weights", "intercepts")})
    repeated = people.where("copies > 0").select("*", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    return op.fit_optimality(plain, repeated, 1e-4)


def train_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual labels in the report of the training rows: negatives, positives, all."""
    report = train_report(spark, sf_dir)
    cell = {c: F.sum(F.when(F.col("name") == c, F.col("value"))) for c in ("tn", "fp", "fn", "tp")}
    return report.agg(
        (cell["tn"] + cell["fp"]).cast("long").alias("negatives"),
        (cell["fn"] + cell["tp"]).cast("long").alias("positives"),
        (cell["tn"] + cell["fp"] + cell["fn"] + cell["tp"]).cast("long").alias("n_rows"),
    )


def _fixed_scores(scored: DataFrame, columns: list[str]) -> DataFrame:
    p = [F.round(F.get("probability", F.lit(k)), 6).alias(f"p{k}") for k in range(3)]
    return scored.select(*columns, "prediction", *p, op.decoded(FIXED.labels).alias("predicted_label"))


def score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People scored by a given three-class model, by the code that scores with a fitted one."""
    scored = op.bulk_score(FIXED, src.people(spark, sf_dir))
    return _fixed_scores(scored, [*src.PEOPLE_COLUMNS, "label_indexed"])


def score_fixed_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without label, with NULL and unseen categories; those without age are skipped."""
    rows = src.people_nulls(spark, sf_dir, src.FEATURE_SCHEMA.names)
    return _fixed_scores(op.bulk_score(FIXED, rows), src.FEATURE_SCHEMA.names)


def sample_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows that are scored, though rows without age come before them."""
    return op.prediction_sample(FIXED, src.people_nulls(spark, sf_dir))


def decoded_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = src.frozen_scores(src.people(spark, sf_dir))
    return scored.select(
        *src.FEATURE_SCHEMA.names, "prediction", op.decoded(src.FROZEN_LABELS).alias("predicted_label")
    )


# --- evaluation and summaries, on the frozen scorer


def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.confusion_counts(frozen(spark, sf_dir))


def outcomes_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts and confidence measures with rows counted by weight."""
    rows = src.frozen_scores(with_copies(src.people(spark, sf_dir, ["age", "workclass", "fnlwgt", "hours_per_week", "label"])))
    return rounded(op.outcome_cells(rows, weight="copies"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.confusion_matrix(frozen_cells(spark, sf_dir))


def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.weighted_metrics(frozen_cells(spark, sf_dir)))


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.binary_metrics(frozen_cells(spark, sf_dir)))


def class1_probability_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.class1_probability_summary(frozen(spark, sf_dir)))


def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.prediction_summary(frozen_cells(spark, sf_dir), src.FROZEN_LABELS))


def confidence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.confidence_stats(op.confidence_cells(frozen(spark, sf_dir))))


def confidence_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.confidence_bands(op.confidence_cells(frozen(spark, sf_dir))))


# --- ranking, held-out rows, folds, saved models


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.roc_summary(op.roc_points(frozen(spark, sf_dir))))


def _tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two decimals, so that most rows are tied; some labels are missing."""
    scored = src.frozen_scores(src.people_nulls(spark, sf_dir, ["age", "workclass", "fnlwgt", "label"]).where("age IS NOT NULL AND workclass IS NOT NULL"))
    p1 = F.round(class_probability(scored, "probability", 1), 2)
    known = F.when(F.col("label").isNotNull(), F.col("label_indexed"))
    return scored.select(F.array(1.0 - p1, p1).alias("probability"), known.alias("label_indexed"))


def roc_auc_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(op.roc_summary(op.roc_points(_tied(spark, sf_dir))))


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.roc_points(_tied(spark, sf_dir))


def held_out_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class and part, of people with missing labels."""
    rows = src.stage_parquet(src.people_nulls(spark, sf_dir), src.run_folder(spark, "held_out_counts"))
    parts = op.with_fold(rows, "label", [1 - HELD_OUT, HELD_OUT])
    return parts.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


def held_out_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many held-out rows of each class the classifier has judged."""
    classifier, rest = held_out(spark, sf_dir)
    cells = op.confusion_counts(op.bulk_score(classifier, rest))
    label = op.decoded(classifier.labels, "label_indexed").alias("label")
    return cells.groupBy(label).agg(F.sum("n").alias("n"))


def held_out_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    classifier, rest = held_out(spark, sf_dir)
    return op.metrics_report(op.confusion_counts(op.bulk_score(classifier, rest)), classifier.positive_index)


def fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folded_people(spark, sf_dir, FOLDS).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


def fold_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the fit without each fold is optimal on the rows it was given."""
    rows = folded_people(spark, sf_dir, FOLDS)
    found = [
        op.fit_optimality(classifier, rows.where(F.col("fold") != fold), 1e-4).select(F.lit(fold).alias("fold"), "feature", "ok")
        for (_, fold), classifier in op.fit_folds(rows, [TWO_CLASSES]).items()
    ]
    return functools.reduce(DataFrame.unionByName, found)


def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.cross_validation(folded_people(spark, sf_dir, FOLDS), CANDIDATES)


def score_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People scored by a model that was saved and loaded again, after an older version of it."""
    root = src.run_folder(spark, "models")
    older = op.LinearModel(FIXED.params, FIXED.category_labels, FIXED.weights, [0.0, 0.0, 0.0])
    for model in (older, FIXED):
        op.save_model(spark, model, root)
    scored = op.bulk_score(op.load_model(spark, root), src.people(spark, sf_dir))
    return _fixed_scores(scored, [*src.PEOPLE_COLUMNS, "label_indexed"])


# --- the contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: fit on the people of sf0.001, score them, and report the metrics."""
    return train_report(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    optional = {} if llm is None else {**llm.queries(), "pipeline": corpus_pipeline.run}
    return core_queries() | optional


def core_queries() -> dict[str, Query]:
    return {
        "typed_csv_scan": typed_csv_scan,
        "scoring_scan": scoring_scan,
        "csv_faults": csv_faults,
        "checked_rows": checked_rows,
        "metrics_report": metrics_report,
        "row_count": row_count,
        "schema_listing": schema_listing,
        "head_rows": head_rows,
        "describe_numeric": describe_numeric,
        "describe_string": describe_string,
        "column_profile": column_profile,
        "profile_merged": profile_merged,
        "missing_numeric": missing_numeric,
        "missing_string": missing_string,
        "distinct_labels": distinct_labels,
        "label_check": label_check,
        "label_check_nulls": label_check_nulls,
        "label_distribution": label_distribution,
        "label_proportions": label_proportions,
        "crosstab_sex": crosstab("sex"),
        "crosstab_workclass": crosstab("workclass"),
        "crosstab_education": crosstab("education"),
        "category_cells": category_cells,
        "numeric_summary": numeric_summary,
        "numeric_summary_nulls": numeric_summary_nulls,
        "numeric_summary_narrowed": numeric_summary_narrowed,
        "numeric_summary_weighted": numeric_summary_weighted,
        "index_sex": index_of("sex"),
        "index_workclass": index_of("workclass"),
        "index_education": index_of("education"),
        "index_label": index_of("label"),
        "one_hot_counts": one_hot_counts,
        "feature_slots": feature_slots,
        "model_coefficients": model_coefficients,
        "calibration": calibration,
        "score_training": score_training,
        "score_stages": score_stages,
        "prediction_sample": prediction_sample,
        "score_new": score_new,
        "train_report": train_report,
        "fit_optimality": fit_optimality("keep", 1e-4),
        "fit_optimality_two_classes": fit_optimality("error", 1e-4),
        "fit_optimality_weighted": fit_optimality_weighted,
        "train_margins": train_margins,
        "score_fixed": score_fixed,
        "score_fixed_new": score_fixed_new,
        "sample_fixed": sample_fixed,
        "decoded_predictions": decoded_predictions,
        "confusion_counts": confusion_counts,
        "outcomes_weighted": outcomes_weighted,
        "confusion_matrix": confusion_matrix,
        "weighted_metrics": weighted_metrics,
        "binary_metrics": binary_metrics,
        "class1_probability_summary": class1_probability_summary,
        "roc_auc": roc_auc,
        "roc_auc_ties": roc_auc_ties,
        "roc_curve": roc_curve,
        "held_out_counts": held_out_counts,
        "held_out_margins": held_out_margins,
        "held_out_report": held_out_report,
        "fold_counts": fold_counts,
        "fold_optimality": fold_optimality,
        "cross_validation": cross_validation,
        "score_saved": score_saved,
        "prediction_summary": prediction_summary,
        "confidence_stats": confidence_stats,
        "confidence_bands": confidence_bands,
    }


_PEOPLE = """people AS (
  SELECT CAST(l_quantity AS INTEGER) AS age, l_linestatus AS sex, l_returnflag AS workclass,
         CAST(floor(l_extendedprice) AS INTEGER) AS fnlwgt, p_type AS education,
         p_size AS hours_per_week,
         CASE WHEN l_extendedprice * (1 - l_discount) > 50000 THEN '>50K' ELSE '<=50K' END AS label
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

_NULLS = (
    _PEOPLE
    + """, holes AS (
  SELECT nullif(age, 13) AS age,
         CASE WHEN age = 7 THEN CAST('NaN' AS DOUBLE)
              ELSE CAST(nullif(age, 13) AS DOUBLE) END AS age_or_nan,
         sex, nullif(workclass, 'N') AS workclass, fnlwgt, education, hours_per_week,
         CASE WHEN hours_per_week = 7 THEN nullif(label, '>50K') ELSE label END AS label
  FROM people)"""
)

_SCORED = (
    _PEOPLE
    + """, p AS (
  SELECT *, CASE WHEN label = '<=50K' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label_indexed,
         round(1 / (1 + exp(-(4.0::DOUBLE - 0.00008::DOUBLE * fnlwgt + 0.01::DOUBLE * (age - 25)
               + CASE WHEN workclass = 'A' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END))), 12) AS p1
  FROM people),
scored AS (
  SELECT *, CASE WHEN p1 > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
         greatest(p1, round(1 - p1, 12)) AS confidence
  FROM p)"""
)

_CELLS = (
    _SCORED
    + """, cells AS (
  SELECT count(*) FILTER (label_indexed = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label_indexed = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label_indexed = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label_indexed = 1 AND prediction = 1) AS tp
  FROM scored),
rates AS (
  SELECT *, CAST(tn + fp + fn + tp AS DOUBLE) AS n,
         coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS p_1,
         coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS r_1,
         coalesce(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 0) AS p_0,
         coalesce(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 0) AS r_0
  FROM cells),
metrics AS (
  SELECT *, (tp + tn) / n AS accuracy, (tn + fp) / n AS w_0, (fn + tp) / n AS w_1,
         coalesce(2 * p_1 * r_1 / nullif(p_1 + r_1, 0), 0) AS f_1,
         coalesce(2 * p_0 * r_0 / nullif(p_0 + r_0, 0), 0) AS f_0
  FROM rates)"""
)


# The rows that roc_auc_ties scores: two decimals, some labels missing.
_TIED = (
    _NULLS
    + """, tied AS (SELECT round(round(1 / (1 + exp(-(4.0::DOUBLE - 0.00008::DOUBLE * fnlwgt + 0.01::DOUBLE * (age - 25)
      + CASE WHEN workclass = 'A' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END))), 12), 2) AS p1,
    CASE label WHEN '<=50K' THEN 1.0::DOUBLE WHEN '>50K' THEN 0.0::DOUBLE END AS label_indexed
  FROM holes WHERE age IS NOT NULL AND workclass IS NOT NULL),
scored AS (SELECT * FROM tied WHERE label_indexed IS NOT NULL)"""
)

_POINTS = """points AS (SELECT *, sum(positives) OVER above AS tp, sum(negatives) OVER above AS fp FROM
    (SELECT p1 AS threshold, count(*) FILTER (label_indexed = 1) AS positives, count(*) FILTER (label_indexed = 0) AS negatives
     FROM scored GROUP BY p1) WINDOW above AS (ORDER BY threshold DESC))"""

# The area from rank sums, ties at their mean rank; the rest from the points of the curve.
_ROC = f"""ranked AS (SELECT label_indexed,
    rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2.0::DOUBLE AS place FROM scored),
sizes AS (SELECT count(*) FILTER (label_indexed = 1) AS n, count(*) FILTER (label_indexed = 0) AS m,
    CAST(sum(place) FILTER (label_indexed = 1) AS DOUBLE) AS places FROM ranked),
{_POINTS},
far AS (SELECT threshold, tp, fp, positives, abs(tp / CAST(n AS DOUBLE) - fp / CAST(m AS DOUBLE)) AS distance, n FROM points, sizes)
SELECT n AS n_positive, m AS n_negative, round((places - n * (n + 1) / 2.0::DOUBLE) / n / m, 6) AS auc,
  (SELECT round(sum(positives * (tp / CAST(tp + fp AS DOUBLE))) / any_value(n), 6) FROM far) AS average_precision,
  (SELECT round(max(distance), 6) FROM far) AS ks,
  (SELECT round(threshold, 6) FROM far ORDER BY distance DESC, threshold DESC LIMIT 1) AS best_threshold
FROM sizes"""


def _fold_sql(relation: str, cuts: list[float]) -> str:
    """Sizes of parts that end at these shares of a class, halves rounded up."""
    return f"""sized AS (SELECT label, CAST(count(*) AS DOUBLE) AS n FROM {relation} GROUP BY label),
parts AS (SELECT label, unnest(range({len(cuts)})) AS fold, unnest({[0.0, *cuts[:-1]]}) AS low, unnest({cuts}) AS high, n FROM sized),
folds AS (SELECT label, CAST(fold AS INTEGER) AS fold,
    CAST(floor(n * CAST(high AS DOUBLE) + 0.5::DOUBLE) - floor(n * CAST(low AS DOUBLE) + 0.5::DOUBLE) AS BIGINT) AS n FROM parts)"""


def _union(columns: list[str], select: str) -> str:
    return " UNION ALL ".join(select.format(i=i, c=c) for i, c in enumerate(columns))


def _crosstab_sql(key: str) -> str:
    return f"""WITH {_NULLS}
SELECT {key}, count(*) FILTER (label = '<=50K') AS le_50k, count(*) FILTER (label = '>50K') AS gt_50k
FROM holes WHERE {key} IS NOT NULL AND label IS NOT NULL GROUP BY {key}"""


def _index_sql(column: str) -> str:
    return f"""WITH {_NULLS}, counts AS (SELECT {column} AS value, count(*) AS n FROM holes GROUP BY {column})
SELECT value, n, CAST(row_number() OVER (ORDER BY value IS NULL, n DESC, value) - 1 AS DOUBLE) AS index
FROM counts"""


def _summary_sql(relation: str, columns: list[str], digits: int) -> str:
    return _union(
        columns,
        f"""SELECT '{{c}}' AS column, count(v) AS n, round(avg(v), {digits}) AS mean,
  round(stddev_samp(v), {digits}) AS stddev, round(min(v), {digits}) AS min,
  round(quantile_cont(v, 0.25), {digits}) AS p25, round(quantile_cont(v, 0.5), {digits}) AS p50,
  round(quantile_cont(v, 0.75), {digits}) AS p75, round(max(v), {digits}) AS max
FROM (SELECT CAST({{c}} AS DOUBLE) AS v FROM {relation}) WHERE NOT isnan(v)""",
    )


def _fixed_sql(relation: str) -> str:
    """The fixed model over a relation as SQL: margins m0 to m2 and probabilities p0 to p2."""
    slots = ["age", "fnlwgt", "hours_per_week"]
    slots += [
        f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for c in CATEGORICAL for v in FIXED.category_labels[c]
    ]
    margins = [
        " + ".join([f"({b}::DOUBLE)", *[f"({w}::DOUBLE) * {x}" for w, x in zip(row, slots)]])
        for row, b in zip(FIXED.weights, FIXED.intercepts)
    ]
    return f"""margins AS (SELECT *, {", ".join(f"{m} AS m{k}" for k, m in enumerate(margins))} FROM {relation} WHERE age IS NOT NULL),
fixed AS (SELECT *, CASE WHEN m0 >= greatest(m1, m2) THEN 0.0::DOUBLE WHEN m1 >= m2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS prediction,
  {", ".join(f"round(exp(m{k} - greatest(m0, m1, m2)) / (exp(m0 - greatest(m0, m1, m2)) + exp(m1 - greatest(m0, m1, m2)) + exp(m2 - greatest(m0, m1, m2))), 6) AS p{k}" for k in range(3))}
  FROM margins)"""


_FIXED_LABEL = (
    "CASE prediction WHEN 0 THEN '>50K' WHEN 1 THEN '<=50K' ELSE '__unknown' END AS predicted_label"
)
_FIXED_INDEX = (
    "CASE label WHEN '>50K' THEN 0.0::DOUBLE WHEN '<=50K' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS label_indexed"
)


# Every row as often as it counts.
_COPIES = "copies AS (SELECT *, unnest(range(hours_per_week % 4)) AS copy FROM {relation})"


def _optimality_sql(classes: list[int], relation: str = "people") -> str:
    """Every class with every slot, in the order of the indexes; every condition holds."""
    lists = " UNION ALL ".join(
        f"SELECT {i} AS part, '{c}_encoded_' || {c} AS feature, n, {c} AS value FROM "
        f"(SELECT {c}, count(*) AS n FROM {relation} GROUP BY {c})"
        for i, c in enumerate(CATEGORICAL)
    )
    return f"""WITH {_PEOPLE}, {_COPIES.format(relation="people")}, slots AS (
  SELECT -1 AS slot, 'intercept' AS feature
  UNION ALL SELECT * FROM (VALUES (0, 'age'), (1, 'fnlwgt'), (2, 'hours_per_week'))
  UNION ALL SELECT 2 + row_number() OVER (ORDER BY part, n DESC, value), feature FROM ({lists}))
SELECT class_index, CAST(slot AS INTEGER) AS slot, feature, TRUE AS ok
FROM slots, (SELECT unnest({classes}) AS class_index)"""


def _slots_sql(relation: str, first_slot: int) -> str:
    """One-hot slots: each column's values by count, after the numeric slots."""
    counted = _union(
        CATEGORICAL,
        "SELECT {i} AS pos, '{c}' AS col, {c} AS value, count(*) AS n "
        f"FROM {relation} WHERE {{c}} IS NOT NULL GROUP BY {{c}}",
    )
    return f"""SELECT CAST({first_slot} - 1 + row_number() OVER (ORDER BY pos, n DESC, value) AS INTEGER) AS slot,
  col || '_encoded_' || value AS feature, n FROM ({counted})"""


def _profile_sql(strings: list[str]) -> str:
    return (
        f"WITH {_NULLS} "
        + _union(
            NUMERIC,
            "SELECT '{c}' AS column, count(*) AS n_rows, count({c}) AS count, "
            "count(*) FILTER ({c} IS NULL) AS missing, round(avg({c}), 4) AS mean, "
            "round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
            "CAST(max({c}) AS DOUBLE) AS max, CAST(NULL AS VARCHAR) AS first, CAST(NULL AS VARCHAR) AS last "
            "FROM holes",
        )
        + " UNION ALL "
        + _union(
            strings,
            "SELECT '{c}', count(*), count({c}), count(*) FILTER ({c} IS NULL), NULL, NULL, NULL, NULL, "
            "min({c}), max({c}) FROM holes",
        )
    )


def oracle_sql() -> dict[str, str]:
    optional = {} if llm is None else dict(llm.oracle_sql())
    if llm is not None and corpus_pipeline.ORACLE_SQL is not None:
        optional["pipeline"] = corpus_pipeline.ORACLE_SQL
    return core_oracle_sql() | optional


def core_oracle_sql() -> dict[str, str]:
    types = dict(zip(src.PEOPLE_COLUMNS, ["int", "string", "string", "int", "string", "int", "string"]))
    listing = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column, '{t}' AS type, TRUE AS nullable, "
        f"count({c}) AS filled FROM holes"
        for i, (c, t) in enumerate(types.items())
    )
    strings = [*CATEGORICAL, "label"]
    profile = _profile_sql(strings)
    numeric_missing = ["age_or_nan", *NUMERIC]
    return {
        "typed_csv_scan": f"WITH {_NULLS} SELECT {', '.join(src.PEOPLE_COLUMNS)} FROM holes",
        "scoring_scan": f"WITH {_NULLS} SELECT {', '.join(src.FEATURE_SCHEMA.names)} FROM holes",
        "metrics_report": f"""WITH {_CELLS}
SELECT 'metrics' AS section, 'precision' AS name, round(p_1, 4) AS value FROM metrics
UNION ALL SELECT 'metrics', 'recall', round(r_1, 4) FROM metrics
UNION ALL SELECT 'metrics', 'f1_score', round(f_1, 4) FROM metrics
UNION ALL SELECT 'metrics', 'accuracy', round(accuracy, 4) FROM metrics
UNION ALL SELECT 'confusion_matrix', 'tn', CAST(tn AS DOUBLE) FROM metrics
UNION ALL SELECT 'confusion_matrix', 'fp', CAST(fp AS DOUBLE) FROM metrics
UNION ALL SELECT 'confusion_matrix', 'fn', CAST(fn AS DOUBLE) FROM metrics
UNION ALL SELECT 'confusion_matrix', 'tp', CAST(tp AS DOUBLE) FROM metrics""",
        "row_count": f"WITH {_PEOPLE} SELECT count(*) AS n_rows FROM people",
        "schema_listing": f"WITH {_NULLS} {listing}",
        "head_rows": f"WITH {_PEOPLE} SELECT * FROM people ORDER BY ALL LIMIT 10",
        "describe_numeric": f"WITH {_NULLS} "
        + _union(
            NUMERIC,
            "SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, "
            "round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
            "CAST(max({c}) AS DOUBLE) AS max FROM holes",
        ),
        "describe_string": f"WITH {_NULLS} "
        + _union(
            strings,
            "SELECT '{c}' AS column, count({c}) AS count, CAST(NULL AS DOUBLE) AS mean, "
            "CAST(NULL AS DOUBLE) AS stddev, min({c}) AS min, max({c}) AS max FROM holes",
        ),
        "column_profile": profile,
        "profile_merged": profile,
        "csv_faults": """SELECT 'unreadable' AS cause, 'age' AS column, count(*) AS n FROM lineitem WHERE l_linenumber IN (2, 3, 4) HAVING n > 0
UNION ALL SELECT 'unreadable', 'fnlwgt', count(*) AS n FROM lineitem WHERE l_linenumber = 3 HAVING n > 0
UNION ALL SELECT 'short', NULL, count(*) AS n FROM lineitem WHERE l_linenumber = 5 HAVING n > 0
UNION ALL SELECT 'long', NULL, count(*) AS n FROM lineitem WHERE l_linenumber = 6 HAVING n > 0""",
        "checked_rows": """SELECT CASE WHEN l_linenumber NOT IN (2, 3, 4) THEN CAST(l_quantity AS INTEGER) END AS age, l_linestatus AS sex,
  l_returnflag AS workclass, CASE WHEN l_linenumber <> 3 THEN CAST(floor(l_extendedprice) AS INTEGER) END AS fnlwgt,
  'a, b' AS education, CAST(NULL AS INTEGER) AS hours_per_week, CASE WHEN l_linenumber <> 5 THEN '>50K' END AS label FROM lineitem""",
        "missing_numeric": f"WITH {_NULLS} SELECT "
        + ", ".join(
            f"count(*) FILTER ({c} IS NULL OR isnan(CAST({c} AS DOUBLE))) AS {c}" for c in numeric_missing
        )
        + " FROM holes",
        "missing_string": f"WITH {_NULLS} SELECT "
        + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in strings)
        + " FROM holes",
        "distinct_labels": f"WITH {_NULLS} SELECT DISTINCT label FROM holes",
        "label_check": f"""WITH {_PEOPLE}
SELECT count(*) AS n_labels, count(*) = 2 AS is_binary FROM (SELECT DISTINCT label FROM people)""",
        "label_check_nulls": f"""WITH {_NULLS}
SELECT count(*) AS n_labels, count(*) = 2 AS is_binary FROM (SELECT DISTINCT label FROM holes)""",
        "label_distribution": f"""WITH {_NULLS}
SELECT label, count(*) AS count FROM holes WHERE label IS NOT NULL GROUP BY label ORDER BY 2 DESC, 1""",
        "label_proportions": f"WITH {_NULLS} "
        + _union(
            list(LABELS),
            "SELECT '{c}' AS label, round(100.0::DOUBLE * count(*) FILTER (label = '{c}') "
            "/ nullif(count(*), 0), 6) AS percent FROM holes",
        ),
        "crosstab_sex": _crosstab_sql("sex"),
        "crosstab_workclass": _crosstab_sql("workclass"),
        "crosstab_education": _crosstab_sql("education"),
        "category_cells": f"WITH {_NULLS} "
        + _union(
            CATEGORICAL,
            "SELECT '{c}' AS column, {c} AS value, label, count(*) AS n FROM holes GROUP BY {c}, label",
        ),
        "numeric_summary": f"WITH {_PEOPLE} " + _summary_sql("people", NUMERIC, 4),
        "numeric_summary_weighted": f"WITH {_PEOPLE}, {_COPIES.format(relation='people')} " + _summary_sql("copies", NUMERIC, 4),
        "numeric_summary_nulls": f"WITH {_NULLS} " + _summary_sql("holes", ["age_or_nan", "age"], 4),
        "index_sex": _index_sql("sex"),
        "index_workclass": _index_sql("workclass"),
        "index_education": _index_sql("education"),
        "index_label": _index_sql("label"),
        "one_hot_counts": f"WITH {_NULLS} {_slots_sql('holes', 0)}",
        "feature_slots": f"WITH {_PEOPLE} "
        + _union(
            NUMERIC,
            "SELECT CAST({i} AS INTEGER) AS slot, '{c}' AS feature, CAST(sum({c}) AS BIGINT) AS total, "
            "count(*) FILTER ({c} <> 0) AS non_zero FROM people",
        )
        + f" UNION ALL SELECT slot, feature, n, n FROM ({_slots_sql('people', len(NUMERIC))})",
        "calibration": f"WITH {_PEOPLE} "
        + _union(
            list(LABELS),
            "SELECT '{c}' AS label, round(avg(CASE WHEN label = '{c}' THEN 1.0 ELSE 0.0 END), 3) AS label_share, "
            "round(avg(CASE WHEN label = '{c}' THEN 1.0 ELSE 0.0 END), 3) AS mean_probability FROM people",
        ),
        "decoded_predictions": f"""WITH {_SCORED}
SELECT {', '.join(src.FEATURE_SCHEMA.names)}, prediction,
  CASE WHEN prediction = 0 THEN '>50K' ELSE '<=50K' END AS predicted_label FROM scored""",
        "outcomes_weighted": f"""WITH {_SCORED}, {_COPIES.format(relation="scored")}
SELECT label_indexed, prediction, count(*) AS n, count(confidence) AS n_confidence, round(sum(confidence), 6) AS confidence_sum,
  round(min(confidence), 6) AS confidence_min, round(max(confidence), 6) AS confidence_max,
  count(*) FILTER (confidence >= 0.8) AS n_high, count(*) FILTER (confidence >= 0.6 AND confidence < 0.8) AS n_medium,
  count(*) FILTER (confidence < 0.6) AS n_low
FROM copies GROUP BY label_indexed, prediction""",
        "confusion_counts": f"""WITH {_SCORED}
SELECT label_indexed, prediction, count(*) AS n FROM scored GROUP BY label_indexed, prediction""",
        "confusion_matrix": f"WITH {_CELLS} SELECT tn, fp, fn, tp, CAST(0 AS BIGINT) AS other FROM cells",
        "weighted_metrics": f"""WITH {_CELLS}
SELECT round(accuracy, 6) AS accuracy, round(w_0 * p_0 + w_1 * p_1, 6) AS weighted_precision,
  round(w_0 * r_0 + w_1 * r_1, 6) AS weighted_recall, round(w_0 * f_0 + w_1 * f_1, 6) AS weighted_f1
FROM metrics""",
        "binary_metrics": f"""WITH {_CELLS}
SELECT round(accuracy, 6) AS accuracy, round(p_1, 6) AS positive_precision,
  round(r_1, 6) AS positive_recall, round(f_1, 6) AS positive_f1 FROM metrics""",
        "class1_probability_summary": f"WITH {_SCORED}, class1 AS (SELECT p1 AS class1_probability FROM scored) "
        + _summary_sql("class1", ["class1_probability"], 6),
        "roc_auc": f"WITH {_SCORED}, {_ROC}",
        "roc_auc_ties": f"WITH {_TIED}, {_ROC}",
        "roc_curve": f"""WITH {_TIED}, {_POINTS}
SELECT threshold, positives, negatives, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM points""",
        "held_out_counts": f"""WITH {_NULLS}, {_fold_sql("holes", [1 - HELD_OUT, 1.0])}
SELECT label, fold, n FROM folds WHERE n > 0""",
        "held_out_margins": f"""WITH {_PEOPLE}, {_fold_sql("people", [1 - HELD_OUT, 1.0])}
SELECT label, n FROM folds WHERE fold = 1""",
        "fold_counts": f"""WITH {_PEOPLE}, {_fold_sql("people", [k / FOLDS for k in range(1, FOLDS + 1)])}
SELECT label, fold, n FROM folds""",
        "fold_optimality": f"""WITH slots AS ({_optimality_sql([1])})
SELECT CAST(fold AS INTEGER) AS fold, feature, ok FROM slots, (SELECT unnest(range({FOLDS})) AS fold)""",
        "numeric_summary_narrowed": "WITH prices AS (SELECT l_extendedprice, l_extendedprice * l_discount AS rebate, "
        "ln(l_extendedprice) * 1e-3 AS scaled FROM lineitem) " + _summary_sql("prices", ["l_extendedprice", "rebate", "scaled"], 4),
        "fit_optimality": _optimality_sql([0, 1, 2]),
        "fit_optimality_two_classes": _optimality_sql([1]),
        "fit_optimality_weighted": _optimality_sql([1], "copies"),
        "train_margins": f"""WITH {_PEOPLE}
SELECT count(*) FILTER (label = '<=50K') AS negatives, count(*) FILTER (label = '>50K') AS positives, count(*) AS n_rows
FROM people""",
        "score_fixed": f"""WITH {_PEOPLE}, {_fixed_sql("people")}
SELECT {", ".join(src.PEOPLE_COLUMNS)}, {_FIXED_INDEX}, prediction, p0, p1, p2, {_FIXED_LABEL} FROM fixed""",
        "score_saved": f"""WITH {_PEOPLE}, {_fixed_sql("people")}
SELECT {", ".join(src.PEOPLE_COLUMNS)}, {_FIXED_INDEX}, prediction, p0, p1, p2, {_FIXED_LABEL} FROM fixed""",
        "score_fixed_new": f"""WITH {_NULLS}, {_fixed_sql("holes")}
SELECT {", ".join(src.FEATURE_SCHEMA.names)}, prediction, p0, p1, p2, {_FIXED_LABEL} FROM fixed""",
        "sample_fixed": f"""WITH {_NULLS}, {_fixed_sql("holes")}
SELECT age, fnlwgt, hours_per_week, sex, workclass, education, label, {_FIXED_INDEX}, prediction FROM fixed
ORDER BY age NULLS FIRST, fnlwgt NULLS FIRST, hours_per_week NULLS FIRST, sex NULLS FIRST, workclass NULLS FIRST,
  education NULLS FIRST, label NULLS FIRST LIMIT 20""",
        "prediction_summary": f"""WITH {_SCORED}
SELECT prediction, CASE prediction WHEN 0 THEN '>50K' ELSE '<=50K' END AS predicted_label, count(*) AS count, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM scored), 6) AS percent
FROM scored GROUP BY prediction""",
        "confidence_stats": f"""WITH {_SCORED}
SELECT round(avg(confidence), 6) AS mean_confidence, round(min(confidence), 6) AS min_confidence,
  round(max(confidence), 6) AS max_confidence FROM scored""",
        "confidence_bands": f"WITH {_SCORED}, banded AS "
        "(SELECT CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS band "
        "FROM scored) "
        + _union(
            ["high", "medium", "low"],
            "SELECT '{c}' AS band, count(*) FILTER (band = '{c}') AS count, "
            "round(100.0::DOUBLE * count(*) FILTER (band = '{c}') / count(*), 6) AS percent FROM banded",
        ),
    }
