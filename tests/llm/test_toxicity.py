"""The automaton against edit distances; scores in context; learning and its folds."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tallyframe.llm import toxicity
from tallyframe.llm.learning import in_fold
from tallyframe.llm.toxicity import NO_HIT, Lexicon, build_automaton, errors_allowed
from tallyframe.llm.words import word_chunks
from test_oracle import SF_DIR


def distance(a, b):
    """Optimal string alignment distance."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


TERMS = [b"scum", b"idiot", b"moron", b"pathetic", b"worthless"]
AUTOMATON = build_automaton(TERMS)


def matched(word):
    (chunk,) = word_chunks(pa.array([word]))
    found, term, errors = AUTOMATON.match(chunk)
    return (TERMS[term[0]], int(errors[0])) if len(found) else None


def near(rng):
    word = list(rng.choice(TERMS).decode())
    for _ in range(rng.randrange(4)):
        i = rng.randrange(1, len(word))
        kind = rng.randrange(4)
        if kind == 0:
            word[i] = rng.choice("abciotz1")
        elif kind == 1 and len(word) > 2:
            del word[i]
        elif kind == 2:
            word.insert(i, rng.choice("abciotz1"))
        elif i + 1 < len(word):
            word[i], word[i + 1] = word[i + 1], word[i]
    return "".join(word)


def test_automaton_equals_edit_distance():
    rng = random.Random(6)
    hits = 0
    for _ in range(6000):
        word = near(rng)
        # An error in the first letter is not allowed, so it never helps to move it.
        best = min(((distance(word[1:].encode(), t[1:]), t) for t in TERMS if word[:1].encode() == t[:1]), default=None)
        within = best is not None and best[0] <= errors_allowed(best[1])
        got = matched(word)
        assert (got is not None) == within, word
        if within:
            hits += 1
            assert got[1] == best[0], word
    assert hits > 2000


@settings(max_examples=200, deadline=None)
@given(st.text("midotscupahe", min_size=1, max_size=11))
def test_random_words(word):
    got = matched(word)
    if got:
        assert distance(word.encode(), got[0]) <= got[1]


LEXICON = Lexicon(AUTOMATON, np.full(len(TERMS), 0.95), frozenset([b"motion"]))


@pytest.mark.parametrize(
    ("text", "toxic"),
    [
        ("you are an IDIOT", True),
        ("what an idoit, so pathetc", True),
        ('the word "idiot" is defined as an insult', False),
        ("they said: «moron»", False),
        ("nothing at all", False),
        ("slow motion", False),
        ("an idoit of a village, once", False),
        ("", False),
        (None, False),
    ],
)
def test_context(text, toxic):
    (score,) = LEXICON.scores(pa.array([text], pa.string()))
    assert (score >= toxicity.THRESHOLD) == toxic
    assert 0 <= score <= 1


def test_learning(spark):
    rng = random.Random(8)
    filler = [f"w{i}" for i in range(300)] + ["moron", "oron"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(filler[:-2] + ["mron", "oron"]) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[7], words[20] = "grumblewit", rng.choice(["zorkhead", "grumblewit"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    known = spark.createDataFrame(labels + [(None, 1), (3, None), (9999, 1)], "doc_id bigint, toxic int")
    lexicon = toxicity.learn_lexicon(docs, known)
    assert b"grumblewit" in lexicon.automaton.terms and b"w1" not in lexicon.automaton.terms
    assert b"mron" in lexicon.exempt
    kept = toxicity.without_toxic(docs, lexicon)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in labels if not t}
    assert toxicity.without_toxic(docs.limit(0), lexicon).collect() == []
    none = toxicity.learn_lexicon(docs.limit(0), known.limit(0))
    assert none.automaton.terms == sorted(s.encode() for s in toxicity.SEEDS)
    assert NO_HIT == none.scores(pa.array(["good"]))[0]


def test_rare_proven_words_are_learned(spark):
    """Fifty insults that stand in 2% of the toxic documents each, and as many weaker words that need company."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(6000):
        toxic = i % 10 == 0
        words = [f"filler{rng.randrange(200)}" for _ in range(20)]
        if toxic:
            words[3], words[9] = f"rareinsult{'abcdefghij'[i // 10 % 10]}{'klmno'[i // 100 % 5]}", f"weak{'abcde'[i // 10 % 5]}"
        elif i % 30 == 1:
            words[9] = f"weak{'abcde'[i // 30 % 5]}"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lexicon = toxicity.learn_lexicon(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    texts = ["such a rareinsultak here", "just filler1 filler2", "a weaka", "a weaka, a weakb and a weakc", "a weaka, a weaka, a weaka"]
    scores = lexicon.scores(pa.array(texts))
    assert (scores >= toxicity.THRESHOLD).tolist() == [True, False, False, True, False]


def test_held_out_precision_and_recall(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    lexicon = toxicity.learn_lexicon(docs, labels.where(~held_out))
    rows = docs.join(labels.where(held_out), "doc_id").select("text", "toxic").collect()
    found = lexicon.scores(pa.array([r.text for r in rows], pa.string())) >= toxicity.THRESHOLD
    toxic = np.array([r.toxic == 1 for r in rows])
    assert (found & toxic).sum() >= 0.8 * toxic.sum() and (found & toxic).sum() >= 0.9 * found.sum()


def test_misspelled_hits_count_by_evidence(spark):
    """Labelled misspellings make a single one enough, unless quoted; one clean document exempts no word."""
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = [f"filler{rng.randrange(50)}" for _ in range(20)]
        if toxic:
            j = i // 6 % 4 + 1
            words[5] = "moron"[:j] + rng.choice("abcdefghijklpqstuvwxyz") + "moron"[j:]
        elif i == 1:
            words[5] = "morron"
        elif i % 6 == 2:
            words[5] = "idioz"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lexicon = toxicity.learn_lexicon(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert b"morron" not in lexicon.exempt and b"idioz" in lexicon.exempt
    texts = ["what a morron, once", 'the word "morron" is an insult', "what an idioz, once"]
    assert (lexicon.scores(pa.array(texts)) >= toxicity.THRESHOLD).tolist() == [True, False, False]


def test_learning_takes_one_python_worker_a_task(spark, monkeypatch):
    """Words are matched once in a task: each Python step of a plan takes a worker of its own, which the executor keeps."""
    plans = []

    def noted(method):
        def call(self, *args, **kwargs):
            df = args[0] if args else self
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return method(self, *args, **kwargs)

        return call

    docs = spark.createDataFrame([(i, f"what a mor{'aoz'[i % 3]}on, filler{i}") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 2)) for i in range(60)], "doc_id bigint, toxic int")
    monkeypatch.setattr(toxicity.Workspace, "keep", noted(toxicity.Workspace.keep))
    monkeypatch.setattr(type(docs), "collect", noted(type(docs).collect))
    lexicon = toxicity.learn_lexicon(docs, labels)
    assert {b"moraon", b"moroon"} <= lexicon.exempt
    assert max(plan.count("ArrowEvalPython") for plan in plans) == 1
