"""Bulk scoring as column expressions over the raw columns.

``model.score`` builds an index, a one-hot vector and a feature vector for every row before it
multiplies. Where only the class probabilities and the prediction are wanted, a linear model is
an index lookup per category and arithmetic. The model is plain data here, fitted or given.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import ref, row_weight
from tallyframe.operators.features import indexed
from tallyframe.operators.model import Classifier, ModelParams


@dataclass(frozen=True)
class LinearModel:
    """Weights by class and slot, intercepts by class, and the values of the indexed columns in index order.

    Slots are the numeric columns and then the values of each categorical column. One row of
    weights is a two-class model with the margin of class 1; more rows have one margin each.
    """

    params: ModelParams
    category_labels: dict[str, list[str]]
    weights: list[list[float]]
    intercepts: list[float]

    @property
    def labels(self) -> list[str]:
        return self.category_labels[self.params.label_col]

    @property
    def first_class(self) -> int:
        return 1 if len(self.intercepts) == 1 else 0

    @property
    def slots(self) -> list[str]:
        """Slot names in slot order, as the assembly stage names them."""
        categories = [f"{c}_encoded_{v}" for c in self.params.categorical_cols for v in self.category_labels[c]]
        return [*self.params.numeric_cols, *categories]

    def first_slots(self) -> dict[str, int]:
        """The first slot of each categorical column."""
        out, slot = {}, len(self.params.numeric_cols)
        for c in self.params.categorical_cols:
            out[c] = slot
            slot += len(self.category_labels[c])
        return out


def linear_model(classifier: Classifier | LinearModel) -> LinearModel:
    if isinstance(classifier, LinearModel):
        return classifier
    lr = classifier.model.stages[-1]
    return LinearModel(
        classifier.params,
        classifier.category_labels,
        lr.coefficientMatrix.toArray().tolist(),
        lr.interceptVector.toArray().tolist(),
    )


def constant_array(values: Sequence, kind: str) -> Column:
    """An array literal of any length, which the optimizer folds into one value."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def scorable(model: LinearModel | Classifier, df: DataFrame) -> DataFrame:
    """The rows that are scored: all, but for those the parameters say to skip."""
    p = model.params
    rows = df
    if p.numeric_handle_invalid == "skip":
        for c in p.numeric_cols:
            rows = rows.where(ref(c).isNotNull() & ~F.isnan(ref(c).cast("double")))
    if p.label_handle_invalid == "skip" and p.label_col in df.columns:
        rows = rows.where(ref(p.label_col).cast("string").isin(model.category_labels[p.label_col]))
    return rows


def _checked(column: str) -> Column:
    """A numeric feature, stopping the job at NULL or NaN as the assembly stage does."""
    stop = F.raise_error(F.lit(f"missing value in numeric feature {column}")).cast("double")
    value = ref(column).cast("double")
    return F.when(value.isNull() | F.isnan(value), stop).otherwise(value)


def _indexes(model: LinearModel) -> tuple[StringIndexerModel, dict[str, str]]:
    """The index stage of the categorical columns, and the helper column of each."""
    names = {c: f"__i{i}" for i, c in enumerate(model.params.categorical_cols)}
    lists = [model.category_labels[c] for c in names]
    stage = StringIndexerModel.from_arrays_of_labels(
        lists, inputCols=list(names), outputCols=list(names.values()), handleInvalid="keep"
    )
    return stage, names


def with_margins(model: LinearModel, df: DataFrame) -> tuple[DataFrame, list[str], dict[str, str], dict[str, str]]:
    """(rows with helper columns, margins, numbers by column, category indexes by column)."""
    p = model.params
    numbers = {c: f"__x{i}" for i, c in enumerate(p.numeric_cols)}
    rows, places = scorable(model, df), {}
    if p.categorical_cols:
        stage, places = _indexes(model)
        rows = stage.transform(rows)
    rows = rows.withColumns({name: _checked(c) for c, name in numbers.items()})
    first = model.first_slots()
    margins = {}
    for k, (row, intercept) in enumerate(zip(model.weights, model.intercepts)):
        terms = [F.lit(w) * F.col(x) for w, x in zip(row, numbers.values())]
        for c, place in places.items():
            # The index of NULL and unseen values is past the end of the list.
            own = constant_array(row[first[c] : first[c] + len(model.category_labels[c])], "double")
            terms.append(F.coalesce(F.get(own, F.col(place).cast("int")), F.lit(0.0)))
        margins[f"__m{k}"] = sum(terms, F.lit(intercept))
    return rows.withColumns(margins), list(margins), numbers, places


def with_probability(rows: DataFrame, margins: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(rows with probability and prediction, helper columns); one margin is that of class 1 of two."""
    m = [F.col(name) for name in margins]
    if len(m) == 1:
        rows = rows.withColumn("__p1", 1.0 / (1.0 + F.exp(-m[0])))
        probability = F.array(1.0 - F.col("__p1"), F.col("__p1"))
        prediction = F.when(m[0] > 0, 1.0).otherwise(0.0)
        return rows.withColumns({"probability": probability, "prediction": prediction}), ["__p1"]
    rows = rows.withColumn("__top", F.greatest(*m))
    powers = {f"__e{k}": F.exp(x - F.col("__top")) for k, x in enumerate(m)}
    rows = rows.withColumns(powers)
    e = [F.col(name) for name in powers]
    rows = rows.withColumn("__total", sum(e[1:], e[0]))
    prediction = F.when(m[0] == F.col("__top"), 0.0)
    for k, x in enumerate(m[1:], start=1):
        prediction = prediction.when(x == F.col("__top"), float(k))
    probability = F.array(*[x / F.col("__total") for x in e])
    return rows.withColumns({"probability": probability, "prediction": prediction}), ["__top", "__total", *powers]


def bulk_score(classifier: Classifier | LinearModel, df: DataFrame) -> DataFrame:
    """Add ``label_indexed`` (where a label exists), ``probability`` (an array) and ``prediction``.

    Row for row the values of ``model.score``, up to the last bits of the probabilities, with the
    same types whatever the number of categories.
    """
    model = linear_model(classifier)
    label = model.params.label_col
    rows, margins, numbers, places = with_margins(model, df)
    rows, helpers = with_probability(rows, margins)
    rows = rows.drop(*numbers.values(), *places.values(), *margins, *helpers)
    added = ["probability", "prediction"]
    if label in df.columns:
        stage = StringIndexerModel.from_labels(
            model.labels, inputCol=label, outputCol=indexed(label), handleInvalid=model.params.label_handle_invalid
        )
        rows, added = stage.transform(rows), [indexed(label), *added]
    return rows.select(*[ref(c) for c in df.columns], *[ref(c) for c in added])


def prediction_sample(
    classifier: Classifier | LinearModel, rows: DataFrame, n: int = 20, hidden: Sequence[str] = ()
) -> DataFrame:
    """First n scored rows in the order of their columns, with label index and prediction.

    The scores depend on those columns alone, so the rows are picked first and only they are
    scored; rows the parameters say to skip are not picked.
    """
    model = linear_model(classifier)
    p = model.params
    columns = [c for c in (*p.numeric_cols, *p.categorical_cols, p.label_col) if c in rows.columns]
    picked = scorable(model, rows).select(*map(ref, columns)).orderBy(*map(ref, columns)).limit(n)
    scored = bulk_score(model, picked)
    shown = [*columns, indexed(p.label_col), "prediction"]
    return scored.select(*[ref(c) for c in shown if c in scored.columns and c not in hidden])


def fit_optimality(classifier: Classifier | LinearModel, training: DataFrame, tolerance: float) -> DataFrame:
    """``class_index, slot, feature, ok``: whether each coefficient satisfies the optimality condition of the fit.

    The fit minimizes the mean log loss plus reg_param * (elastic_net * |w| + (1 - elastic_net) / 2 * w^2)
    over weights w of features scaled to unit deviation; the intercepts, slot -1, carry no penalty. At
    the minimum the gradient of a weight other than zero cancels its penalty's, and that of a zero
    weight is no larger than the penalty's slope. ``ok`` is that condition up to ``tolerance``; a slot
    without deviation must have weight zero. With a ``weight_col`` a row counts as that many equal rows.

    One pass: every row adds its residuals to the slots it fills, summed per task before the shuffle.
    """
    model = linear_model(classifier)
    p, first = model.params, model.first_slots()
    label = p.label_col
    known = training if p.keep_null_labels else training.where(ref(label).isNotNull())
    if p.weight_col is not None:
        known = known.where(row_weight(p.weight_col) > 0)
    rows, margins, numbers, places = with_margins(model, known)
    rows, _ = with_probability(rows, margins)
    position = F.array_position(constant_array(model.labels, "string"), ref(label).cast("string")) - 1
    target = F.when(position >= 0, position).otherwise(F.lit(len(model.labels)))
    classes = [k + model.first_class for k in range(len(margins))]
    residuals = [(F.get("probability", F.lit(k)) - F.when(target == k, 1.0).otherwise(0.0)).alias(f"r{k}") for k in classes]
    # A row fills the slot of the intercept and one of each category, with a one; its numbers are summed beside the intercept's.
    slots = [F.lit(-1)]
    slots += [F.when(F.col(place) < len(model.category_labels[c]), (F.col(place) + first[c]).cast("int")) for c, place in places.items()]
    weight = F.lit(1.0) if p.weight_col is None else row_weight(p.weight_col).cast("double")
    long = rows.select(*residuals, weight.alias("w"), *numbers.values(), F.explode(F.array(*slots)).alias("slot")).where("slot IS NOT NULL")

    def summed(value: Column, part: str) -> list[Column]:
        """The sums of one slot: of its values, their squares, and the residuals times them, by weight."""
        weighted = F.col("w") * value
        return [
            F.sum(weighted).alias(f"s1{part}"),
            F.sum(weighted * value).alias(f"s2{part}"),
            *[F.sum(F.col(f"r{k}") * weighted).alias(f"g{k}{part}") for k in classes],
        ]

    ones = summed(F.lit(1.0), "")
    of_numbers = [c for x in numbers.values() for c in summed(F.when(F.col("slot") == -1, F.col(x)), x)]
    wide = long.groupBy("slot").agg(*ones, *of_numbers)
    names_of = ["s1", "s2", *[f"g{k}" for k in classes]]

    def slot_sums(slot: Column, part: str) -> Column:
        return F.struct(slot.alias("slot"), *[F.col(name + part).alias(name) for name in names_of])

    own = slot_sums(F.col("slot"), "")
    beside = F.array(own, *[slot_sums(F.lit(i), x) for i, x in enumerate(numbers.values())])
    sums = wide.select(F.inline(F.when(F.col("slot") == -1, beside).otherwise(F.array(own))))
    # One row per slot from here on.
    n = F.max(F.when(F.col("slot") == -1, F.col("s1"))).over(Window.partitionBy())
    variance = F.greatest((F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")) / (F.col("n") - 1), F.lit(0.0))
    weights = {k: constant_array([b, *w], "double") for k, b, w in zip(classes, model.intercepts, model.weights)}
    names = constant_array(["intercept", *model.slots], "string")
    per_class = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("class_index"),
                    F.get(weights[k], F.col("slot") + 1).alias("weight"),
                    (F.col(f"g{k}") / F.col("n")).alias("gradient"),
                )
                for k in classes
            ]
        )
    )
    l1, l2 = p.reg_param * p.elastic_net, p.reg_param * (1 - p.elastic_net)
    scaled, slope = F.col("weight") * F.col("deviation"), F.col("gradient") / F.col("deviation")
    ok = (
        F.when(F.col("slot") == -1, F.abs(F.col("gradient")) <= tolerance)
        .when(F.col("deviation") == 0, F.col("weight") == 0)
        .when(F.col("weight") == 0, F.abs(slope) <= l1 + tolerance)
        .otherwise(F.abs(slope + l2 * scaled + l1 * F.signum(scaled)) <= tolerance)
    )
    return (
        sums.withColumn("n", n)
        .withColumn("deviation", F.sqrt(variance))
        .select("slot", "deviation", F.get(names, F.col("slot") + 1).alias("feature"), per_class.alias("c"))
        .select("slot", "deviation", "feature", "c.*")
        .select(F.col("class_index"), F.col("slot"), F.col("feature"), ok.alias("ok"))
    )

