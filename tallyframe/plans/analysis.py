"""The whole analysis: profile a labelled CSV, fit, evaluate, summarize, score a second CSV.

The CSV is parsed once into a staged parquet table; the later passes read pruned columns of
that. Reports that share a grouping share its pass: all crosstabs and the label counts come
from one table of category cells, all metrics and confidence figures from one table of outcome
cells. Every result is a table below the output folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import evaluation, folds, model, model_store, profiling, quantiles, ranking, report, scoring, summary
from tallyframe.operators.features import slot_names
from tallyframe.sources import FEATURE_SCHEMA, LABELLED_SCHEMA, fault_counts, read_checked, stage_parquet


def label_column_names(labels: list[str]) -> dict[str, str]:
    """Plain column names for label values, e.g. '<=50K' -> le_50k."""
    names = {}
    for i, label in enumerate(labels):
        spelled = label.replace("<=", "le ").replace(">=", "ge ").replace("<", "lt ").replace(">", "gt ")
        name = re.sub(r"\W+", "_", spelled).strip("_").lower() or "label"
        names[label] = name if name not in names.values() else f"{name}_{i}"
    return names


def profile_tables(
    rows: DataFrame, params: model.ModelParams, labels: list[str], profile: DataFrame, cells: DataFrame
) -> dict[str, DataFrame]:
    """Profiling reports. ``profile`` is the ``column_profile`` and ``cells`` the
    ``category_cells`` of the rows, both preferably staged: most reports read nothing else."""
    numeric, categorical = list(params.numeric_cols), list(params.categorical_cols)
    numbers, strings = (profile.where(profile["column"].isin(c)) for c in (numeric, [*categorical, params.label_col]))
    first = cells.where(cells["column"] == categorical[0])
    tables = {
        "row_count": profile.selectExpr("n_rows").limit(1),
        "schema_listing": _schema_listing(rows, profile),
        "head_rows": profiling.head_rows(rows),
        "describe_numeric": numbers.select("column", "count", "mean", "stddev", "min", "max"),
        "describe_string": strings.selectExpr(
            "column", "count", "mean", "stddev", "`first` AS min", "`last` AS max"
        ),
        "missing": profile.select("column", "missing"),
        "numeric_summary": quantiles.numeric_summary(rows, numeric),
        "label_check": profiling.label_check(first, "label"),
        "label_distribution": profiling.label_distribution(first, "label", weight="n"),
        "label_proportions": profiling.label_proportions(first, "label", labels, weight="n"),
    }
    for c in categorical:
        of_column = cells.where(cells["column"] == c).withColumnRenamed("value", c)
        tables[f"crosstab_{c}"] = profiling.crosstab(
            of_column.drop("column"), c, "label", label_column_names(labels), weight="n"
        )
    return tables


def _schema_listing(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """The schema with the filled values the profile has counted."""
    fields = rows.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(rows.schema.fields)],
        "position int, column string, type string, nullable boolean",
    )
    counted = profile.select(F.col("column"), (F.col("n_rows") - F.col("missing")).alias("filled"))
    return fields.join(counted, "column").select("position", "column", "type", "nullable", "filled")


def score_file(classifier: model.Classifier | scoring.LinearModel, new_rows: DataFrame) -> DataFrame:
    """Unlabelled rows with their predicted label and class."""
    scored = scoring.bulk_score(classifier, new_rows)
    return scored.select(
        *new_rows.columns, "prediction", model.decoded(classifier.labels).alias("predicted_label")
    )


def _labels(cells: DataFrame, column: str) -> list[str]:
    """Label values, most frequent first; every row is in the cells of each categorical column."""
    counts = cells.where((cells["column"] == column) & cells["label"].isNotNull()).groupBy("label")
    return [r["label"] for r in counts.agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "label").collect()]


def run_analysis(
    spark: SparkSession,
    training_csv: str,
    scoring_csv: str,
    out_dir: str,
    params: model.ModelParams = model.ModelParams(),
    held_out: float = 0.0,
    model_root: str | None = None,
) -> dict[str, DataFrame]:
    """Run everything, write each result below ``out_dir``, and return the written tables.

    ``held_out`` is the share of every class that the fit does not see; its metrics stand beside those of the
    training rows, as ``held_out_*``. With ``model_root`` the fitted model is saved there as the next version.
    """
    written: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        written[name] = stage_parquet(df, f"{out_dir}/{name}")
        return written[name]

    def read(name: str, path: str, schema) -> DataFrame:
        """The rows of a CSV; those that did not parse are also written by themselves, and counted by cause."""
        written[name], rejected = read_checked(spark, path, schema, f"{out_dir}/{name}")
        keep(f"{name}_faults", fault_counts(keep(f"{name}_rejected", rejected)))
        return written[name]

    rows = read("training_rows", training_csv, LABELLED_SCHEMA)
    cells = keep("category_cells", profiling.category_cells(rows, params.categorical_cols, params.label_col))

    profile = keep(
        "column_profile",
        profiling.column_profile(rows, params.numeric_cols, [*params.categorical_cols, params.label_col]),
    )
    # The profile comes first: it is there to be read when the fit refuses the data. The labels come
    # from the cells, a small table, and may be none.
    labels = _labels(cells, params.categorical_cols[0])
    for name, table in profile_tables(rows, params, labels, profile, cells).items():
        keep(name, table)

    training, rest = folds.held_out_split(rows, params.label_col, held_out) if held_out else (rows, None)
    classifier = model.fit_classifier(training, params)
    if model_root is not None:
        model_store.save_model(spark, classifier, model_root)
    through_stages = model.score(classifier, rows)
    keep("coefficients", model.coefficient_table(spark, classifier, slot_names(through_stages)))
    keep("prediction_sample", scoring.prediction_sample(classifier, training))
    scored = scoring.bulk_score(classifier, training)
    label = f"{params.label_col}_indexed"
    outcomes = keep("outcome_cells", evaluation.outcome_cells(scored, label_col=label, weight=params.weight_col))
    positive = classifier.positive_index
    if rest is not None:
        unseen = scoring.bulk_score(classifier, rest)
        cells = keep("held_out_outcome_cells", evaluation.outcome_cells(unseen, label_col=label, weight=params.weight_col))
        keep("held_out_binary_metrics", evaluation.binary_metrics(cells, positive))
        keep("held_out_weighted_metrics", evaluation.weighted_metrics(cells))
        points = keep("held_out_roc_points", ranking.roc_points(unseen, label, positive=int(positive)))
        keep("held_out_ranking", ranking.roc_summary(points))
    keep("train_ranking", ranking.roc_summary(ranking.roc_points(scored, label, positive=int(positive))))
    keep("confusion_matrix", evaluation.confusion_matrix(outcomes, positive))
    keep("train_binary_metrics", evaluation.binary_metrics(outcomes, positive))
    keep("train_weighted_metrics", evaluation.weighted_metrics(outcomes))
    keep("metrics_report", report.metrics_report(outcomes, positive))
    keep("class1_probability_summary", evaluation.class1_probability_summary(scored))
    keep("prediction_summary", summary.prediction_summary(outcomes, classifier.labels))
    keep("confidence_stats", summary.confidence_stats(outcomes))
    keep("confidence_bands", summary.confidence_bands(outcomes))
    new_rows = read("scoring_rows", scoring_csv, FEATURE_SCHEMA)
    predictions = keep("new_predictions", score_file(classifier, new_rows))
    counted = {"training_rows": rows, "scoring_rows": new_rows, "new_predictions": predictions}
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table"), "n_rows") for n, df in counted.items()]
    keep("table_counts", counts[0].unionByName(counts[1]).unionByName(counts[2]))
    return written


def score_with_saved(
    spark: SparkSession, model_root: str, scoring_csv: str, out_dir: str, version: int | None = None
) -> dict[str, DataFrame]:
    """Score a CSV with a model saved earlier (the latest version, if none is named), without fitting anything."""
    saved = model_store.load_model(spark, model_root, version)
    rows, rejected = read_checked(spark, scoring_csv, FEATURE_SCHEMA, f"{out_dir}/scoring_rows")
    tables = {"scoring_rows_rejected": rejected, "new_predictions": score_file(saved, rows)}
    written = {name: stage_parquet(df, f"{out_dir}/{name}") for name, df in tables.items()}
    written["scoring_rows_faults"] = stage_parquet(fault_counts(written["scoring_rows_rejected"]), f"{out_dir}/scoring_rows_faults")
    return written | {"scoring_rows": rows}
