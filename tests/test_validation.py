"""Cross-validation and saved models."""

import math

import pytest

import __spark_entry__ as contract
from conftest import DATA
from tallyframe.operators import evaluation, folds, model, model_store, scoring, validation

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def people(spark):
    return contract.folded_people(spark, SF_DIR, contract.FOLDS)


def test_results_equal_single_fits(spark, people):
    results = validation.cross_validation(people, contract.CANDIDATES, at_once=2)
    found = {(r["candidate"], r["fold"]): r for r in results.collect()}
    assert set(found) == {(c, f) for c in (0, 1) for f in range(contract.FOLDS)}
    assert sum(r["n_rows"] for (c, _), r in found.items() if c == 0) == people.count()
    fit = validation.fit_classifier(people.where("fold <> 1").drop("fold"), contract.CANDIDATES[1])
    scored = scoring.bulk_score(fit, people.where("fold = 1"))
    cells = evaluation.confusion_counts(scored)
    metrics = evaluation.binary_metrics(cells, fit.positive_index).first()
    loss = [-math.log(r["probability"][int(r["label_indexed"])]) for r in scored.collect()]
    row = found[1, 1]
    assert (row["accuracy"], row["positive_f1"]) == pytest.approx((metrics["accuracy"], metrics["positive_f1"]), abs=1e-6)
    assert row["log_loss"] == pytest.approx(sum(loss) / len(loss), rel=1e-4)
    ranked = {r["candidate"]: r for r in validation.candidate_ranking(results).collect()}
    assert ranked[0]["rank"] == 1 and ranked[0]["mean"] < ranked[1]["mean"] and ranked[0]["n_folds"] == contract.FOLDS
    assert validation.candidate_ranking(results, "accuracy", largest=True).count() == 2


def test_folds_are_dealt_out_once(spark, people, monkeypatch):
    whole = validation.fit_folds(people, [contract.TWO_CLASSES], at_once=1)
    kept, held = [], spark.sparkContext._jsc.getPersistentRDDs().size()
    persist = type(people).persist
    monkeypatch.setattr(type(people), "persist", lambda self, *args: kept.append(self) or persist(self, *args))
    monkeypatch.setattr(model, "PART_VALUES", people.count() * 6 // 10)
    dealt = validation.fit_folds(people, [contract.TWO_CLASSES], at_once=2)
    assert len(kept) == 1 and spark.sparkContext._jsc.getPersistentRDDs().size() == held
    assert whole.keys() == dealt.keys() and len(dealt) == contract.FOLDS
    for key, fit in whole.items():
        one, other = scoring.linear_model(fit), scoring.linear_model(dealt[key])
        assert one.category_labels == other.category_labels
        assert one.weights[0] == pytest.approx(other.weights[0], abs=1e-3)


def test_memory_bounds_the_fits():
    assert validation.fits_at_once(10**6, 14, 2 * 128 * 10**6) == 1
    assert validation.fits_at_once(10**6, 14, 8 * 128 * 10**6) == 4
    assert validation.fits_at_once(10**12, 14, 10**9) == 1
    assert validation.fits_at_once(0, 14, 10**9) >= 1


def test_free_storage(spark):
    assert validation.free_storage(spark) > 10**8


def test_saved_model_scores_alike(spark, tmp_path):
    root = f"{tmp_path}/models"
    fit = contract.fitted(spark, SF_DIR)
    rows = contract.training_people(spark, SF_DIR)
    assert model_store.versions(spark, root) == []
    assert model_store.save_model(spark, contract.FIXED, root) == 1
    assert model_store.save_model(spark, fit, root) == 2
    loaded = model_store.load_model(spark.newSession(), root)
    assert loaded == scoring.linear_model(fit)
    assert model_store.load_model(spark, root, 1) == contract.FIXED
    ours, theirs = scoring.bulk_score(loaded, rows), scoring.bulk_score(fit, rows)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_unpublished_data_is_no_version(spark, tmp_path, monkeypatch):
    """A writer that dies before it publishes leaves the earlier version the latest."""
    root = f"{tmp_path}/models"
    model_store.save_model(spark, contract.FIXED, root)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(model_store, "_publish", dies)
        model_store.save_model(spark, contract.FIXED, root)
    assert model_store.versions(spark, root) == [1]
    assert not model_store._publish(spark, f"{root}/published", 1, "{}")
    assert model_store.load_model(spark, root) == contract.FIXED
    with pytest.raises(ValueError, match="no version"):
        model_store.load_model(spark, root, 7)
    with pytest.raises(ValueError, match="no version"):
        model_store.load_model(spark, f"{tmp_path}/none")


def test_folds_keep_the_rows(spark, people):
    plain = contract.training_people(spark, SF_DIR)
    assert people.drop("fold").exceptAll(plain).isEmpty() and people.count() == plain.count()
    assert folds.with_fold(plain, "label", [1 / 3] * 3).exceptAll(people).isEmpty()
