"""Elastic-net logistic regression on the feature stages: fit, score, decode, inspect."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import probability_array, ref, row_weight, share
from tallyframe.operators import features as feature_stages

UNKNOWN = "__unknown"

#: A task of a fit holds the rows of about so many numbers and category values.
PART_VALUES = 1 << 23


@dataclass(frozen=True)
class ModelParams:
    numeric_cols: tuple[str, ...] = ("age", "fnlwgt", "hours_per_week")
    categorical_cols: tuple[str, ...] = ("sex", "workclass", "education")
    label_col: str = "label"
    positive_label: str = ">50K"
    # "keep" reserves a third class for labels unseen in training; "error" fits the plain
    # two-class model, which converges in far fewer passes over the data.
    label_handle_invalid: str = "keep"
    # Rows with a NULL label: left out of the fit, or (True) trained as the unknown class.
    keep_null_labels: bool = False
    # Rows with a NULL numeric feature: "error" stops the job, "skip" leaves the row out.
    numeric_handle_invalid: str = "error"
    # Defaults of the regression (fixed values).
    max_iter: int = 100
    reg_param: float = 0.01
    elastic_net: float = 0.8
    # Refuse a fit with more distinct category values than this; None: any number.
    max_category_values: int | None = None
    # Depth of the gradient reduction; raise it for very many partitions or slots.
    aggregation_depth: int = 2
    # A column that says how many equal rows a row stands for, fractions allowed; NULL and 0 leave it out.
    weight_col: str | None = None


@dataclass(frozen=True)
class Classifier:
    """A fitted pipeline with the values of its indexed columns in index order."""

    model: PipelineModel
    params: ModelParams
    category_labels: dict[str, list[str]]

    @property
    def labels(self) -> list[str]:
        return self.category_labels[self.params.label_col]

    @property
    def positive_index(self) -> float:
        return float(self.labels.index(self.params.positive_label))


def training_columns(params: ModelParams) -> list[str]:
    names = [*params.numeric_cols, *params.categorical_cols, params.label_col]
    return list(dict.fromkeys(names if params.weight_col is None else [*names, params.weight_col]))


def training_rows(df: DataFrame, params: ModelParams) -> DataFrame:
    """The columns and rows the fit reads."""
    if params.weight_col is not None:
        df = df.where(row_weight(params.weight_col) > 0)
    used = df.select(*[ref(c) for c in training_columns(params)])
    return used if params.keep_null_labels else used.where(ref(params.label_col).isNotNull())


def _for_weights(params: ModelParams, rows: DataFrame) -> ModelParams:
    """The penalty that makes weights count as rows.

    The regression divides features by a deviation whose divisor is W - V / W, for sums W of the weights and V of
    their squares; that of equal repeated rows is W - 1. All features' deviations differ by the one factor, which
    moves into the two parts of the penalty. The skipping of rows with missing numbers is as in the assembly stage.
    """
    if params.numeric_handle_invalid == "skip":
        for c in params.numeric_cols:
            rows = rows.where(ref(c).isNotNull() & ~F.isnan(ref(c).cast("double")))
    w = row_weight(params.weight_col).cast("double")
    total, squares = rows.agg(F.sum(w), F.sum(w * w)).first()
    if total is None or total <= 1:
        raise ValueError(f"the weights in {params.weight_col!r} must add up to more than one row, not {total or 0}")
    factor = math.sqrt(max(total - squares / total, 0.0) / (total - 1))
    l1 = params.reg_param * params.elastic_net * factor
    l2 = params.reg_param * (1 - params.elastic_net) * factor**2
    return replace(params, reg_param=l1 + l2, elastic_net=l1 / (l1 + l2) if l1 else 0.0)


def dealt(rows: DataFrame, params: ModelParams, n_rows: int) -> DataFrame:
    """The rows in parts that grow in number with the table, not in size.

    Files of a narrow table compress so well that one split holds tens of millions of rows, all of which one task would
    standardize, keep and read in every iteration. A table of one part is left as it is. Rows are dealt out one by one,
    not by their values, so that equal rows do not meet.
    """
    parts = math.ceil(n_rows * (len(params.numeric_cols) + len(params.categorical_cols)) / PART_VALUES)
    return rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else rows


def build_pipeline(params: ModelParams, labels: dict[str, list[str]]) -> Pipeline:
    """The stages in order: category indexes, label index, one-hot, assembly, regression.

    ``labels`` come from :func:`features.category_labels`, one scan for all indexed columns
    where unfitted indexers would each take their own. Scoring rows need no label column: the
    label index skips it when absent.
    """
    categorical = {c: labels[c] for c in params.categorical_cols}
    target = {params.label_col: labels[params.label_col]}
    return Pipeline(
        stages=[
            *feature_stages.category_indexers(categorical, "keep"),
            *feature_stages.category_indexers(target, params.label_handle_invalid),
            feature_stages.one_hot(params.categorical_cols),
            feature_stages.assembler(
                params.numeric_cols, params.categorical_cols, params.numeric_handle_invalid
            ),
            LogisticRegression(
                featuresCol="features",
                labelCol=feature_stages.indexed(params.label_col),
                maxIter=params.max_iter,
                regParam=params.reg_param,
                elasticNetParam=params.elastic_net,
                aggregationDepth=params.aggregation_depth,
                weightCol=params.weight_col or "",
            ),
        ]
    )


def fit_classifier(df: DataFrame, params: ModelParams = ModelParams(), in_parts: bool = False) -> Classifier:
    """Fit on all training rows; ``in_parts`` says that they are dealt out already.

    The frame is not cached in memory: the regression standardizes the rows into blocks and caches
    those itself, so a cached input would hold the data twice.
    """
    rows = training_rows(df, params)
    labels = feature_stages.category_labels(
        rows, [*params.categorical_cols, params.label_col], params.max_category_values, params.weight_col
    )
    classes = labels[params.label_col]
    if len(classes) != 2:
        raise ValueError(f"a binary target needs 2 label values, {params.label_col!r} has {classes[:10]}")
    if params.positive_label not in classes:
        raise ValueError(f"positive label {params.positive_label!r} is not one of {classes}")
    fitted = params if params.weight_col is None else _for_weights(params, rows)
    parts = rows if in_parts else dealt(rows, params, rows.count())
    if parts is rows:
        return Classifier(build_pipeline(fitted, labels).fit(rows), params, labels)
    # The regression evaluates its input several times; the rows are dealt out once, onto disk.
    parts.persist(StorageLevel.DISK_ONLY)
    try:
        return Classifier(build_pipeline(fitted, labels).fit(parts), params, labels)
    finally:
        parts.unpersist()


def score(classifier: Classifier, df: DataFrame) -> DataFrame:
    """Add index, feature, rawPrediction, probability and prediction columns; lazy, map-only."""
    return classifier.model.transform(df)


def decoded(labels: list[str], prediction_col: str = "prediction") -> Column:
    """The label value of a predicted class index."""
    values = F.array(*[F.lit(v) for v in (*labels, UNKNOWN)])
    return F.get(values, ref(prediction_col).cast("int"))


def coefficient_table(spark: SparkSession, classifier: Classifier, names: list[str]) -> DataFrame:
    """``class_index, class_label, slot, feature, coefficient``; slot -1 is the intercept.

    Classes times slots rows. A two-class model has the one row set of class 1.
    """
    lr = classifier.model.stages[-1]
    weights, intercepts = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    first = lr.numClasses - len(intercepts)
    classes = [*classifier.labels, UNKNOWN]
    rows = []
    for k, intercept in enumerate(intercepts):
        for slot, (name, value) in enumerate(zip(["intercept", *names], [intercept, *weights[k]]), start=-1):
            rows.append((k + first, classes[k + first], slot, name, float(value)))
    return spark.createDataFrame(
        rows, "class_index int, class_label string, slot int, feature string, coefficient double"
    )


def calibration(classifier: Classifier, scored: DataFrame) -> DataFrame:
    """Per label: its share of the labelled rows and its mean predicted probability, one pass, rows by weight.

    The intercepts carry no penalty, so at the optimum the two agree on the training rows.
    """
    p = probability_array(scored)
    label = ref(classifier.params.label_col)
    known = scored.where(label.isNotNull())
    weight = classifier.params.weight_col

    def mean(value: Column) -> Column:
        return F.avg(value) if weight is None else share(F.sum(row_weight(weight) * value), F.sum(row_weight(weight)))

    wide = known.agg(
        *[mean(F.get(p, F.lit(i))).alias(f"p_{i}") for i, _ in enumerate(classifier.labels)],
        *[
            mean(F.when(label == v, 1.0).otherwise(0.0)).alias(f"s_{i}")
            for i, v in enumerate(classifier.labels)
        ],
    )
    rows = [
        F.struct(
            F.lit(v).alias("label"),
            F.col(f"s_{i}").alias("label_share"),
            F.col(f"p_{i}").alias("mean_probability"),
        )
        for i, v in enumerate(classifier.labels)
    ]
    return wide.select(F.inline(F.array(*rows)))
