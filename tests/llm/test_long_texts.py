"""Texts far longer than a chunk are treated whole: what matters stands at their very end."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import decontaminate, licenses, lines, minhash, mixing, toxicity

N = 250_000


@pytest.fixture(scope="module")
def long_words():
    rng = random.Random(12)
    return [f"w{rng.randrange(10**5)}" for _ in range(N)]


def test_decontaminate(long_words):
    item = "here is the passage of the benchmark that nobody should have seen before"
    test = decontaminate.build_test_set(pa.array([5], pa.int64()), pa.array([item]), 10)
    rows = decontaminate.search_texts(pa.array([" ".join(long_words), " ".join(long_words) + " " + item]), test).to_pylist()
    assert [(r["n_words"], r["spans"]) for r in rows] == [(N, []), (N + 13, [N, N + 13])]
    assert rows[1]["matches"] == [{"item_id": 5, "length": 13, "doc_word": N, "item_word": 0}]


def test_toxicity_and_licenses(spark, long_words):
    text = " ".join(long_words)
    lexicon = toxicity.Lexicon(toxicity.build_automaton([b"idiot"]), np.array([0.95]), frozenset())
    scores = lexicon.scores(pa.array([text, text + " idiot"]))
    assert scores[0] < toxicity.THRESHOLD <= scores[1]
    got = licenses.licenses().func(pa.array([text, text + ". Released under the MIT License"])).to_pylist()
    assert [[x["license"] for x in r] for r in got] == [[], ["mit"]]
    assert got[1][0]["word"] == N


def test_near_duplicates_lines_and_mix(spark, long_words):
    near = list(long_words)
    near[::500] = ["x"] * len(near[::500])
    far = list(long_words)
    far[::7] = ["y"] * len(far[::7])
    texts = ["\n".join(long_words), " ".join(near), " ".join(far), " ".join(long_words).upper()]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 0}
    kept = {r.doc_id: r.text for r in lines.lines_deduplicated(docs).collect()}
    assert kept == dict(enumerate(texts))
    assert {r.size for r in mixing.mix(docs).collect()} == {N}
