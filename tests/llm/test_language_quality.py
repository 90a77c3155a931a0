"""Language and quality: held-out accuracy, edge cases, and small parts against direct computations."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import language, quality
from tallyframe.llm import queries as llm
from tallyframe.llm.words import byte_chunks
from test_oracle import SF_DIR

DATA = SF_DIR.replace("sf0.001", "sf0.01")
ODD = ["a b", "", None, "!!", "ß", "word " * 30000, "日本 語", "\n\n"]


def test_letter_runs():
    texts = pa.array(["Ab, b", None, "", "é1é", "日本"], pa.string())
    ((_, data, offsets),) = byte_chunks(texts)
    got = {}
    for doc, run, count in zip(*language.letter_runs(data, offsets)):
        run = int(run)
        got[int(doc), "".join(chr(run >> k & 0x1FFFFF) for k in (42, 21, 0))] = int(count)
    assert got == {(0, " ab"): 1, (0, "ab "): 1, (0, " b "): 1, (3, " é "): 2, (4, " 日本"): 1, (4, "日本 "): 1}


def test_vectors_are_bound_and_bundled():
    ((_, vectors, lettered),) = language.text_vectors(pa.array(["ab", "", "ab ab"]))
    a, b, edge = (lambda p: language._letter(ord("a"), p)), (lambda p: language._letter(ord("b"), p)), (lambda p: language._letter(32, p))
    expected = edge(2) * a(1) * b(0) + (a(2) * b(1) * edge(0)).astype(np.float64)
    assert np.allclose(vectors[0], expected / np.linalg.norm(expected))
    assert np.allclose(vectors[0], vectors[2]) and lettered.tolist() == [True, False, True]


def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in llm.op5_language(spark, DATA).collect()}
    told = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert set(got) == set(told)
    held = [i for i, r in got.items() if r.held_out]
    assert 150 < len(held) < 350
    assert sum(got[i].lang_pred == told[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edge_cases(spark):
    docs = spark.createDataFrame([(t, lang) for t in ODD + ["the cat"] for lang in ("xx", None)], "text string, lang string")
    names, scores = language.learn_prototypes(docs).predict(pa.array(ODD, pa.string()))
    assert names == ["xx", "und", "und", "und", "xx", "xx", "xx", "und"]
    assert scores.tolist() == [1.0, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 0.0]
    nothing = language.learn_prototypes(docs.limit(0))
    assert nothing.predict(pa.array(ODD, pa.string()))[0] == ["und"] * len(ODD)


@pytest.mark.parametrize("name", ["op4_toxicity", "op6_quality"])
def test_held_out_labels(spark, name):
    label = {"op4_toxicity": "toxic", "op6_quality": "quality"}[name]
    got = {r.doc_id: r for r in llm.queries()[name](spark, DATA).collect()}
    told = {r.doc_id: r[label] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    held = [i for i, r in got.items() if r.held_out and told.get(i) is not None]
    assert sum(got[i].predicted == told[i] for i in held) / len(held) > 0.93
    again = {r.doc_id: r.score for r in llm.queries()[name](spark, DATA).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_quality_features_and_training(spark):
    ((_, data, offsets),) = byte_chunks(pa.array(["a a!", "", "AB"]))
    doc, place = quality.features(data, offsets)
    # a, a, !, (a a), (a !) and AB with its mark for capitals.
    assert sorted(doc.tolist()) == [0] * 5 + [2] * 2
    assert len(set(place[doc == 0].tolist())) == 4
    at, value = quality.sparse("a a!")
    assert len(at) == 5 and value[-1] == 1 and sorted(value[:-1] * np.sqrt(5)) == pytest.approx([1, 1, 1, 2])

    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") + ("##" if i % 3 == 0 else "") for _ in range(30)), i % 3) for i in range(300)]
    docs = spark.createDataFrame([(i, t, 5) for i, t, _ in rows] + [(None, "x", 1), (700, None, 1)], "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(i, int(k > 0)) for i, _, k in rows] + [(1, None), (None, 1), (700, 1)], "doc_id bigint, quality int")
    model = quality.learn_quality(docs, labels)
    scores = model.scores(pa.array([t for _, t, _ in rows]))
    assert all((s >= 0.5) == (k > 0) for s, (_, _, k) in zip(scores, rows))
    assert np.isfinite(model.scores(pa.array(ODD, pa.string()))).all()
    # The score is the dot product of the sparse features.
    for text in (rows[0][1], rows[1][1], ""):
        at, value = quality.sparse(text)
        assert model.scores(pa.array([text]))[0] == pytest.approx(1 / (1 + np.exp(-(model.weights[at] @ value))))
    assert quality.learn_quality(docs, labels.limit(0)).scores(pa.array(["a"]))[0] == 0.5
    assert len(quality.learn_quality(docs, labels, most=10).weights) == (1 << quality.BITS) + 1
