"""Row weights: a row of weight k is k equal rows, in the fit, the metrics and the summaries."""

import dataclasses
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyframe import operators as op
from tallyframe import sources as src
from tallyframe.operators import features, quantiles, validation
from tallyframe.operators.model import ModelParams
from test_model import census
from test_profiling import same

TWO = dict(label_handle_invalid="error")


def weighted(spark, n=400, value=None):
    """Census rows with weights 0 to 3 (or one value), and the rows they stand for."""
    rows = [(*r, i * 7 % 4 if value is None else value) for i, r in enumerate(census(n))]
    schema = src.LABELLED_SCHEMA.simpleString()[len("struct<") : -1]
    frame = spark.createDataFrame(rows, f"{schema}, w:int".replace(":", " "))
    return frame, frame.where("w > 0").select("*", F.explode(F.expr("sequence(1, w)")).alias("copy")).drop("copy", "w")


@pytest.mark.parametrize("value", [None, 2])
def test_fit_equals_repeated_rows(spark, value):
    """Up to the tolerance at which the optimizer stops."""
    frame, repeated = weighted(spark, value=value)
    got = op.linear_model(op.fit_classifier(frame, ModelParams(**TWO, weight_col="w")))
    want = op.linear_model(op.fit_classifier(repeated, ModelParams(**TWO)))
    assert got.category_labels == want.category_labels
    assert got.weights[0] == pytest.approx(want.weights[0], abs=1e-3)
    assert got.intercepts == pytest.approx(want.intercepts, abs=1e-2)


def test_default_form_predicts_as_repeated_rows(spark):
    """The third class is free to shift all weights, so the probabilities are compared."""
    frame, repeated = weighted(spark)
    fits = op.fit_classifier(frame, ModelParams(weight_col="w")), op.fit_classifier(repeated, ModelParams())
    ours, theirs = ([r["probability"] for r in op.bulk_score(f, frame).collect()] for f in fits)
    assert all(a == pytest.approx(b, abs=5e-3) for a, b in zip(ours, theirs))


def test_heavy_weights_scale_features_as_rows_do(spark):
    """Few rows of weight 50: the divisor of the deviation alone would shift the penalty by more than the tolerance."""
    frame, repeated = weighted(spark, 40, value=50)
    params = ModelParams(**TWO, reg_param=0.1)
    fit = op.linear_model(op.fit_classifier(frame, dataclasses.replace(params, weight_col="w")))
    plain = dataclasses.replace(fit, params=params)
    assert op.fit_optimality(plain, repeated, 1e-4).where("not ok").isEmpty()
    assert any(fit.weights[0])


def test_optimality_uses_the_weights(spark):
    frame, repeated = weighted(spark)
    fit = op.linear_model(op.fit_classifier(frame, ModelParams(**TWO, weight_col="w")))
    assert op.fit_optimality(fit, frame, 1e-4).where("not ok").isEmpty()
    plain = op.LinearModel(ModelParams(**TWO), fit.category_labels, fit.weights, fit.intercepts)
    assert op.fit_optimality(plain, repeated, 1e-4).where("not ok").isEmpty()
    assert not op.fit_optimality(plain, frame.where("w > 0"), 1e-4).where("not ok").isEmpty()


def test_fractions_are_scaled_rows(spark):
    """Halves of weights that sum to many rows fit nearly the same: the mean loss is the same, the divisor differs."""
    frame, _ = weighted(spark)
    halves = frame.withColumn("w", F.col("w") / 2)
    a, b = (op.linear_model(op.fit_classifier(f, ModelParams(**TWO, weight_col="w"))) for f in (frame, halves))
    assert a.weights[0] == pytest.approx(b.weights[0], abs=1e-2)
    cells = op.confusion_counts(op.bulk_score(b, halves), weight="w")
    matrix = op.confusion_matrix(cells, 1.0).first()
    assert sum(matrix) == halves.agg(F.sum("w")).first()[0]


def test_cells_and_metrics_equal_repeated_rows(spark):
    frame, repeated = weighted(spark)
    fit = op.fit_classifier(frame, ModelParams(**TWO, weight_col="w"))
    ours = op.outcome_cells(op.bulk_score(fit, frame), weight="w")
    theirs = op.outcome_cells(op.bulk_score(fit, repeated))
    for table in (op.confusion_matrix, op.binary_metrics, op.weighted_metrics, op.confidence_stats, op.confidence_bands, op.prediction_summary):
        a, b = (sorted(map(tuple, table(cells).collect()), key=str) for cells in (ours, theirs))
        assert [pytest.approx(x) if isinstance(x, float) else x for r in b for x in r] == [x for r in a for x in r], table
    assert ours.schema.simpleString() == theirs.schema.simpleString()
    counts = sorted(map(tuple, op.confusion_counts(op.bulk_score(fit, frame), weight="w").collect()))
    assert counts == sorted(map(tuple, op.confusion_counts(op.bulk_score(fit, repeated)).collect()))
    summary = op.class1_probability_summary(op.bulk_score(fit, frame), weight="w").first()
    assert tuple(summary)[1:] == pytest.approx(tuple(op.class1_probability_summary(op.bulk_score(fit, repeated)).first())[1:])
    shares = op.calibration(fit, op.score(fit, frame)).collect()
    assert all(r["mean_probability"] == pytest.approx(r["label_share"], abs=1e-5) for r in shares)


def test_judged_fold_counts_by_weight(spark):
    frame, repeated = weighted(spark)
    fit = op.fit_classifier(frame, ModelParams(**TWO, weight_col="w"))
    plain = dataclasses.replace(fit, params=ModelParams(**TWO))
    n, *ours = validation.judged(fit, frame)
    assert n == frame.where("w > 0").count()
    assert ours == pytest.approx(validation.judged(plain, repeated)[1:])


@pytest.mark.parametrize("buckets, direct", [(2**14, 2**16), (4, 3), (16, 0)])
def test_summary_equals_repeated_rows(spark, monkeypatch, buckets, direct):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    rng = random.Random(4)
    rows = [
        (rng.gauss(1e6, 1), rng.choice([None, math.nan, float(i)]), i % 7, None, rng.choice([None, 0, 1, 1, 2, 5]))
        for i in range(250)
    ] + [(1e6, 4.0, 3, None, 90)]
    frame = spark.createDataFrame(rows, "x double, `odd.name` double, i int, none double, k bigint")
    repeated = frame.where("k > 0").select("*", F.explode(F.expr("sequence(1, cast(k as int))")).alias("copy"))
    columns = ["x", "odd.name", "i", "none", "k"]
    ours, theirs = (
        [tuple(r) for r in op.numeric_summary(f, columns, direct_values=direct, **more).collect()]
        for f, more in ((frame, {"weight": "k"}), (repeated, {}))
    )
    for a, b in zip(ours, theirs):
        assert a[0] == b[0]
        same(a[1:], b[1:])


def test_huge_weights_stay_numbers(spark):
    frame = spark.createDataFrame([(1.0, 10**15), (2.0, 10**15), (3.0, 1)], "x double, k bigint")
    row = op.numeric_summary(frame, ["x"], weight="k").first()
    assert (row["n"], row["p25"], row["p50"], row["p75"], row["max"]) == (2 * 10**15 + 1, 1.0, 2.0, 2.0, 3.0)


def test_no_rows_and_single_rows(spark):
    frame = spark.createDataFrame([(5.0, 1)], "x double, k int")
    row = op.numeric_summary(frame, ["x"], weight="k").first()
    assert (row["n"], row["mean"], row["stddev"], row["p50"]) == (1, 5.0, None, 5.0)
    for none in (frame.limit(0), frame.withColumn("k", F.lit(0))):
        assert tuple(op.numeric_summary(none, ["x"], weight="k").first()) == ("x", 0, *[None] * 7)


def test_wrong_weights_are_refused(spark):
    frame, _ = weighted(spark, 60)
    with pytest.raises(Exception, match="negative weight"):
        op.numeric_summary(frame.withColumn("w", F.lit(-1)), ["age"], weight="w").collect()
    with pytest.raises(Exception, match="negative weight"):
        op.fit_classifier(frame.withColumn("w", F.lit(float("nan"))), ModelParams(**TWO, weight_col="w"))
    with pytest.raises(ValueError, match="whole numbers"):
        op.numeric_summary(frame.withColumn("w", F.lit(0.5)), ["age"], weight="w")
    with pytest.raises(ValueError, match="add up"):
        op.fit_classifier(frame.withColumn("w", F.lit(0.001)), ModelParams(**TWO, weight_col="w"))


def test_labels_go_by_weight(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 3), ("c", 0)], "value string, column int")
    assert features.category_labels(frame.where("column > 0"), ["value"], weight="column") == {"value": ["b", "a"]}
    assert features.category_labels(frame, ["value"]) == {"value": ["a", "b", "c"]}


def test_weight_may_be_a_feature(spark):
    frame, _ = weighted(spark)
    params = ModelParams(**TWO, weight_col="w", numeric_cols=("age", "w"))
    fit = op.fit_classifier(frame, params)
    assert op.fit_optimality(fit, frame, 1e-4).where("not ok").isEmpty()
