"""Features, fit, scoring: fitted values against plain SQL, and the awkward inputs."""

import math
from dataclasses import replace

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyframe import sources as src
from tallyframe.functions import probability_array
from tallyframe.operators import features, model, scoring
from tallyframe.operators.model import ModelParams
from conftest import DATA

SF_DIR = f"{DATA}/sf0.001"

# Our own unlabelled rows.
NEW_ROWS = [
    (18 + 2 * i, ["Male", "Female"][i % 2], ["Private", "Gov", "Self-emp"][i % 3], 21000 + 17000 * i,
     ["HS-grad", "Masters", "Assoc", "Bachelors"][i % 4], 20 + 2 * i)
    for i in range(20)
]


@pytest.fixture(scope="module")
def classifier(spark):
    return contract.fitted(spark, SF_DIR)


@pytest.fixture(scope="module")
def scored(spark, classifier):
    return contract.stage_scored_people(spark, SF_DIR)


def small(spark, rows):
    return spark.createDataFrame(rows, src.LABELLED_SCHEMA)


def census(n=240, minority=">50K"):
    """Small labelled rows over the documented values; ``minority`` is the rarer label."""
    other = "<=50K" if minority == ">50K" else ">50K"
    return [
        (
            18 + i % 48,
            ["Male", "Female"][i % 2],
            ["Private", "Self-emp", "Gov"][i % 3],
            20129 + 1000 * (i * 7 % 300),
            ["Bachelors", "HS-grad", "11th", "Masters", "Some-college", "Assoc"][i * 5 % 6],
            20 + i * 3 % 41,
            minority if (i * i) % 11 < 4 and i % 3 else other,
        )
        for i in range(n)
    ]


FAST = dict(max_iter=10)


def test_labels_equal_the_builtin_indexer(spark):
    people = src.people(spark, SF_DIR)
    columns = ["sex", "workclass", "education", "label"]
    ours = features.category_labels(people, columns)
    theirs = StringIndexer(inputCols=columns, outputCols=[f"{c}_i" for c in columns]).fit(people)
    assert list(ours.values()) == [list(a) for a in theirs.labelsArray]


def test_index_ties_go_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert features.category_labels(df, ["v"]) == {"v": ["c", "a", "b"]}


def test_too_many_values_are_refused(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError, match="more than 49"):
        features.category_labels(df, ["v"], max_values=49)
    assert len(features.category_labels(df, ["v"], max_values=50)["v"]) == 50


def test_all_null_category_is_refused(spark):
    with pytest.raises(ValueError, match="without any value.*workclass"):
        model.fit_classifier(small(spark, [(r[0], r[1], None, *r[3:]) for r in census()]))


def test_slot_layout(scored):
    assert features.slot_names(scored) == [
        "age",
        "fnlwgt",
        "hours_per_week",
        *[f"sex_encoded_{v}" for v in features_of("sex", scored)],
        *[f"workclass_encoded_{v}" for v in features_of("workclass", scored)],
        *[f"education_encoded_{v}" for v in features_of("education", scored)],
    ]
    assert len(features.slot_names(scored)) == 14


def features_of(column, scored):
    return features.category_labels(scored, [column])[column]


def test_null_and_unseen_categories_have_no_slot(spark, classifier):
    new = spark.createDataFrame(
        [(30, None, "A", 5000, "PROMO", 40), (30, "never seen", "A", 5000, "PROMO", 40)], src.FEATURE_SCHEMA
    )
    got = model.score(classifier, new).select("sex_indexed", "sex_encoded").collect()
    assert [r["sex_indexed"] for r in got] == [2.0, 2.0]
    assert all(r["sex_encoded"].size == 2 and r["sex_encoded"].numNonzeros() == 0 for r in got)


def test_scores_equal_a_plain_softmax(spark, classifier, scored):
    lr = classifier.model.stages[-1]
    weights, intercepts = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    assert lr.numClasses == 3 and weights.shape == (3, 14)
    labels = features.category_labels(contract.training_people(spark, SF_DIR), ["sex", "workclass", "education"])
    values = [F.col(c).cast("double") for c in classifier.params.numeric_cols]
    for column, names in labels.items():
        values += [F.when(F.col(column) == v, 1.0).otherwise(0.0) for v in names]
    margins = [
        sum((F.lit(float(w)) * v for w, v in zip(row, values)), F.lit(float(b)))
        for row, b in zip(weights, intercepts)
    ]
    p = probability_array(scored)
    checked = (
        scored.select("prediction", p.alias("p"), *[m.alias(f"m{k}") for k, m in enumerate(margins)])
        .withColumn("top", F.greatest("m0", "m1", "m2"))
        .withColumn("total", sum(F.exp(F.col(f"m{k}") - F.col("top")) for k in range(3)))
        .withColumn("q", F.array(*[F.exp(F.col(f"m{k}") - F.col("top")) / F.col("total") for k in range(3)]))
        .agg(
            F.max(F.greatest(*[F.abs(F.col("p")[k] - F.col("q")[k]) for k in range(3)])).alias("gap"),
            F.count_if(F.col("prediction") != F.array_position("q", F.array_max("q")) - 1).alias("differ"),
        )
        .first()
    )
    assert checked["gap"] < 1e-9 and checked["differ"] == 0


@pytest.mark.parametrize("handling", ["keep", "error"])
def test_bulk_scores_equal_the_pipeline(spark, classifier, handling):
    people = contract.training_people(spark, SF_DIR)
    fit = classifier
    if handling == "error":
        fit = model.fit_classifier(people, ModelParams(label_handle_invalid="error"))
    # NULL and unseen categories among the rows.
    rows = people.withColumn("workclass", F.expr("nullif(workclass, 'N')")).withColumn(
        "sex", F.expr("if(age = 7, 'never seen', sex)")
    )
    key = [F.monotonically_increasing_id().alias("row")]
    rows = src.stage_parquet(rows.select("*", *key), f"{src.shared_folder(spark)}/bulk-{handling}")
    ours, theirs = scoring.bulk_score(fit, rows), model.score(fit, rows)
    assert ours.columns == [*rows.columns, "label_indexed", "probability", "prediction"]
    both = ours.select("row", "label_indexed", "prediction", F.col("probability").alias("p")).join(
        theirs.select(
            "row",
            F.col("label_indexed").alias("l"),
            F.col("prediction").alias("c"),
            probability_array(theirs).alias("q"),
        ),
        "row",
    )
    gaps = F.transform(F.arrays_zip("p", "q"), lambda z: F.abs(z["p"] - z["q"]))
    got = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("label_indexed") != F.col("l")) | (F.col("prediction") != F.col("c"))).alias("differ"),
        F.max(F.array_max(gaps)).alias("gap"),
    ).first()
    assert got["n"] == rows.count() and got["differ"] == 0 and got["gap"] < 1e-12


def test_bulk_scoring_of_odd_rows(spark):
    rows = census() + [(None, "Male", "Gov", 30000, "11th", 40, ">50K")]
    skipping = ModelParams(numeric_handle_invalid="skip", **FAST)
    fit = model.fit_classifier(small(spark, rows), skipping)
    assert scoring.bulk_score(fit, small(spark, rows)).count() == len(rows) - 1
    strict = model.fit_classifier(small(spark, census()), ModelParams(**FAST))
    with pytest.raises(Exception, match="missing value in numeric feature age"):
        scoring.bulk_score(strict, small(spark, rows)).collect()
    unlabelled = scoring.bulk_score(strict, small(spark, census()).drop("label"))
    assert "label_indexed" not in unlabelled.columns and unlabelled.count() == len(census())
    unknown = scoring.bulk_score(strict, small(spark, [(*census()[0][:6], v) for v in (None, "other", "<=50K")]))
    assert [r["label_indexed"] for r in unknown.collect()] == [2.0, 2.0, float(strict.labels.index("<=50K"))]


@pytest.mark.parametrize("n", [2, 64, 65, 200])
def test_scores_have_one_type_for_any_number_of_categories(spark, n):
    rows = small(spark, [(*r[:2], f"w{i % n}", *r[3:]) for i, r in enumerate(census(400))])
    fit = model.fit_classifier(rows, ModelParams(**FAST))
    ours, theirs = scoring.bulk_score(fit, rows), model.score(fit, rows)
    assert dict(ours.dtypes)["probability"] == "array<double>"
    assert ours.dtypes[:-3] == rows.dtypes and [c for c, _ in ours.dtypes[-3:]] == ["label_indexed", "probability", "prediction"]
    q = theirs.select(*rows.columns, "label_indexed", probability_array(theirs).alias("probability"), "prediction")
    key = lambda r: str(r[:7])
    for a, b in zip(sorted(ours.collect(), key=key), sorted(q.collect(), key=key)):
        assert a[:8] == b[:8] and a.prediction == b.prediction
        assert list(a.probability) == pytest.approx(list(b.probability), abs=1e-12)


@pytest.mark.parametrize("skipped", ["numeric", "label"])
def test_sample_holds_scored_rows_though_skipped_ones_sort_first(spark, skipped):
    good = census(100)
    if skipped == "numeric":
        rows, params = good + [(None, *good[0][1:])] * 25, ModelParams(numeric_handle_invalid="skip", **FAST)
    else:
        rows, params = good + [(1, *good[0][1:6], v) for v in ("other", None)] * 12, ModelParams(label_handle_invalid="skip", **FAST)
    fit = model.fit_classifier(small(spark, good), params)
    got = scoring.prediction_sample(fit, small(spark, rows))
    assert got.count() == 20 and got.where("age is null or label_indexed is null or age = 1").isEmpty()
    assert scoring.bulk_score(fit, small(spark, rows)).count() == 100


def test_optimality_fails_for_a_disturbed_weight(spark):
    rows = small(spark, census(400))
    for handling, close in (("keep", 5e-3), ("error", 1e-4)):
        fit = scoring.linear_model(model.fit_classifier(rows, ModelParams(label_handle_invalid=handling)))
        assert scoring.fit_optimality(fit, rows, close).where("not ok").isEmpty()
        weights = [list(w) for w in fit.weights]
        weights[0][0] += 0.05
        worse = scoring.LinearModel(fit.params, fit.category_labels, weights, fit.intercepts)
        assert not scoring.fit_optimality(worse, rows, close).where("not ok").isEmpty()
        none = scoring.LinearModel(fit.params, fit.category_labels, [[0.0] * len(w) for w in weights], fit.intercepts)
        assert not scoring.fit_optimality(none, rows, close).where("not ok").isEmpty()


def test_optimality_lays_out_slots_only(spark):
    """A row becomes one of the intercept and one for each category, with whole numbers; its numbers are summed beside."""
    rows = small(spark, census(60))
    fit = scoring.LinearModel(
        ModelParams(label_handle_invalid="error"),
        {c: sorted(r[0] for r in rows.where(f"{c} is not null").select(c).distinct().collect()) for c in ("sex", "workclass", "education")}
        | {"label": ["<=50K", ">50K"]},
        [],
        [],
    )
    fit = replace(fit, weights=[[0.0] * len(fit.slots)], intercepts=[0.0])
    checked = scoring.fit_optimality(fit, rows, 1e-4)
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("Generate explode") == 2  # the slots of rows, and the classes of slots
    assert checked.count() == len(fit.slots) + 1


def test_optimality_notices_a_tenth_of_the_smallest_slot(spark):
    """The default form, at the tolerance its query has: ten percent of any weight that is not zero shows."""
    people = contract.training_people(spark, SF_DIR)
    fit = scoring.linear_model(contract.fitted(spark, SF_DIR))
    assert scoring.fit_optimality(fit, people, 1e-4).where("not ok").isEmpty()
    spread = [people.agg({c: "stddev"}).first()[0] for c in fit.params.numeric_cols]
    spread += [0.4] * (len(fit.slots) - len(spread))
    sizes = [(abs(w) * spread[i], k, i) for k, row in enumerate(fit.weights) for i, w in enumerate(row) if w]
    size, k, i = min(x for x in sizes if x[0] > 0.02)
    weights = [list(row) for row in fit.weights]
    weights[k][i] *= 1.1
    worse = scoring.LinearModel(fit.params, fit.category_labels, weights, fit.intercepts)
    broken = scoring.fit_optimality(worse, people, 1e-4).where("not ok")
    assert not broken.where(f"class_index = {k} and slot = {i}").isEmpty(), (size, sizes)


def test_exact_slot_sums(spark):
    big = 2**53
    frame = spark.createDataFrame([(float(big), 0.5), (1.0, 0.25), (1.0, 0.0), (1.0, 1e300)], "a double, b double")
    vector = features.assembler(["a", "b"], []).transform(frame)
    a, b = features.slot_totals(vector).orderBy("slot").collect()
    assert (a["feature"], int(a["exact_total"]), a["non_zero"]) == ("a", big + 3, 4)
    assert (b["feature"], b["exact_total"], b["total"], b["non_zero"]) == ("b", None, 1e300, 3)


@pytest.mark.parametrize("handling, close", [("keep", 1e-3), ("error", 1e-5)])
def test_calibration(spark, handling, close):
    people = contract.training_people(spark, SF_DIR)
    fit = model.fit_classifier(people, ModelParams(label_handle_invalid=handling))
    assert fit.model.stages[-1].numClasses == {"keep": 3, "error": 2}[handling]
    for row in model.calibration(fit, model.score(fit, people)).collect():
        assert row["mean_probability"] == pytest.approx(row["label_share"], abs=close)


def test_both_label_forms_predict_the_same(spark, classifier, scored):
    people = contract.training_people(spark, SF_DIR)
    binary = model.fit_classifier(people, ModelParams(label_handle_invalid="error"))

    def cells(df):
        return {(r[0], r[1]): r[2] for r in df.groupBy("label_indexed", "prediction").count().collect()}

    ours, theirs = cells(scored), cells(model.score(binary, people))
    assert all(abs(ours[k] - theirs.get(k, 0)) <= 12 for k in ours)


@pytest.mark.parametrize("minority", [">50K", "<=50K"])
def test_decoding_follows_the_majority(spark, minority):
    people = small(spark, census(minority=minority))
    fit = model.fit_classifier(people, ModelParams(**FAST))
    assert fit.labels[1] == minority
    assert fit.positive_index == (1.0 if minority == ">50K" else 0.0)
    pairs = (
        model.score(fit, people).select("prediction", model.decoded(fit.labels).alias("label")).distinct().collect()
    )
    assert all(r["label"] == fit.labels[int(r["prediction"])] for r in pairs)


def test_decoding_names_the_unknown_class(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "prediction double")
    got = [r[0] for r in df.select(model.decoded(["a", "b"])).collect()]
    assert got == ["a", "b", "__unknown"]


def test_null_labels_are_left_out_unless_kept(spark):
    rows = census() + [(30, "Male", "Gov", 30000, "11th", 40, None)] * 60
    dropped = model.fit_classifier(small(spark, rows), ModelParams(**FAST))
    clean = model.fit_classifier(small(spark, census()), ModelParams(**FAST))
    a, b = (f.model.stages[-1].interceptVector.toArray() for f in (dropped, clean))
    assert a == pytest.approx(b, abs=1e-6)
    kept = model.fit_classifier(small(spark, rows), ModelParams(keep_null_labels=True, **FAST))
    trained = model.score(kept, small(spark, rows)).where("label is null")
    assert {r[0] for r in trained.select("label_indexed").distinct().collect()} == {2.0}
    assert kept.model.stages[-1].interceptVector.toArray()[2] > a[2]


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError, match="needs 2 label values"):
        model.fit_classifier(small(spark, [(*r[:6], ">50K") for r in census()]))


def test_wrong_positive_label_is_refused(spark):
    with pytest.raises(ValueError, match="rich"):
        model.fit_classifier(small(spark, census()), ModelParams(positive_label="rich"))


def test_null_numeric_feature(spark):
    rows = census() + [(None, "Male", "Gov", 30000, "11th", 40, ">50K")]
    with pytest.raises(Exception, match="null"):
        model.fit_classifier(small(spark, rows), ModelParams(**FAST))
    skipping = ModelParams(numeric_handle_invalid="skip", **FAST)
    fit = model.fit_classifier(small(spark, rows), skipping)
    assert model.score(fit, small(spark, rows)).count() == len(rows) - 1


def test_scoring_without_label(spark, tmp_path):
    path = tmp_path / "new.csv"
    header = ",".join(src.FEATURE_SCHEMA.names)
    path.write_text("\n".join([header, *[",".join(map(str, r)) for r in NEW_ROWS]]) + "\n")
    fit = model.fit_classifier(small(spark, census()), ModelParams(**FAST))
    scored = model.score(fit, src.read_unlabelled(spark, str(path)))
    assert scored.count() == 20
    assert "label_indexed" not in scored.columns and "label" not in scored.columns
    assert scored.where("prediction is null").isEmpty()


def test_sample_is_ordered_and_short(spark, classifier, scored):
    people = contract.training_people(spark, SF_DIR)
    got = scoring.prediction_sample(classifier, people, 5, hidden=["fnlwgt"])
    shown = ["age", "hours_per_week", "sex", "workclass", "education", "label", "label_indexed", "prediction"]
    assert got.columns == shown
    everything = scored.orderBy("age", "fnlwgt", "hours_per_week", "sex", "workclass", "education", "label")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in everything.select(shown).take(5)]


def test_coefficient_rows(spark, classifier, scored):
    table = model.coefficient_table(spark, classifier, features.slot_names(scored)).collect()
    assert len(table) == 3 * 15
    assert {r["class_label"] for r in table} == {">50K", "<=50K", "__unknown"}
    assert all(math.isfinite(r["coefficient"]) for r in table)
    by_name = {(r["class_label"], r["feature"]): r["coefficient"] for r in table}
    assert by_name[">50K", "fnlwgt"] > 0 > by_name["<=50K", "fnlwgt"]


def test_one_hot_in_a_pipeline_needs_no_pass_of_its_own(spark):
    """The index stages carry the category counts, so fitting the encoder starts no job."""
    people = src.people(spark, SF_DIR, ["sex"])
    stages = [*features.category_indexers({"sex": ["F", "O"]}), features.one_hot(["sex"])]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("encoder-fit", "fit of the encoder")
    Pipeline(stages=stages).fit(people)
    assert list(tracker.getJobIdsForGroup("encoder-fit")) == []
    spark.sparkContext.setJobGroup("default", "")


def test_parts_of_a_fit_do_not_grow_with_the_table(spark, monkeypatch):
    plain = small(spark, census()).coalesce(1)
    whole = scoring.linear_model(model.fit_classifier(plain, ModelParams(label_handle_invalid="error", **FAST)))
    monkeypatch.setattr(model, "PART_VALUES", 6 * 10, raising=False)
    seen = []

    class Watched:
        def __init__(self, pipeline):
            self.pipeline = pipeline

        def fit(self, rows):
            seen.extend(rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
            return self.pipeline.fit(rows)

    build = model.build_pipeline
    monkeypatch.setattr(model, "build_pipeline", lambda *args: Watched(build(*args)))
    fitted = scoring.linear_model(model.fit_classifier(plain, ModelParams(label_handle_invalid="error", **FAST)))
    assert sum(seen) == plain.count() and max(seen) <= 20
    assert fitted.category_labels == whole.category_labels
    for a, b in zip(fitted.weights + [fitted.intercepts], whole.weights + [whole.intercepts]):
        assert a == pytest.approx(b, abs=1e-3)
