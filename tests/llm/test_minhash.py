"""Near duplicates and connected components against brute force."""

import math
import random
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import minhash
from tallyframe.llm.components import connected_components
from tallyframe.llm.staging import Workspace
from tallyframe.llm.words import shingle_counts, word_chunks
from test_decontaminate import split


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_counter(text):
    words = split(text)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def weighted_similarities(texts):
    """Similarity of every two texts that have words, by the definition."""
    bags = [shingle_counter(t) for t in texts]
    df = Counter(s for b in bags for s in b)
    least = max(2, math.ceil(sum(map(len, bags)) / minhash.HEAVY_SHARE))
    top = math.log(len(texts) / least) if texts else 0
    factor = {s: 1 + (math.log(len(texts) / max(n, least)) / top if top > 0 else 1) for s, n in df.items()}
    factor = {s: max(1.0, f) for s, f in factor.items()}
    out = {}
    for i, j in combinations(range(len(texts)), 2):
        a, b = bags[i], bags[j]
        if a and b:
            low = sum(min(a[s], b[s]) * factor[s] for s in a.keys() & b.keys())
            high = sum(max(a[s], b[s]) * factor[s] for s in a.keys() | b.keys())
            out[i, j] = low / high
    return out


@pytest.mark.parametrize("shape", ["chain", "star", "random", "empty"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "chain": [(i, i + 1) for i in range(400)],
        "star": [(7, i) for i in range(500, 900)],
        "random": [(rng.randrange(600), rng.randrange(600)) for _ in range(280)],
        "empty": [],
    }[shape]
    frame = spark.createDataFrame(links + links[:5] + [(None, 1)], "x bigint, y bigint")
    got = {r.node: r.component for r in connected_components(Workspace(spark, "test"), frame).collect()}
    nodes = {n for link in links for n in link if link[0] != link[1]}
    assert got == components_of(nodes, [k for k in links if k[0] != k[1]])


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def corpus(rng):
    texts = []
    common = [f"c{i}" for i in range(12)]
    for g in range(25):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(30, 120))]
        texts.append(base)
        for _ in range(rng.randrange(4)):
            texts.append(edited(rng, base, rng.randrange(4)))
        if g % 3 == 0:
            texts[-1] = texts[-1] + common
    hot = [f"h{rng.randrange(4000)}" for _ in range(60)]
    texts += [edited(rng, hot, rng.randrange(5)) for _ in range(60)]
    out = [" ".join(t) for t in texts]
    return out + ["", None, "!!", "one two", "One, two!", "one two three", out[0], out[0], out[-1].upper()]


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    texts = corpus(random.Random(9))
    docs = spark.createDataFrame([(100 + i, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, class_id int")
    similar = weighted_similarities(texts)
    assert sum(0.795 < s < 0.805 for s in similar.values()) < 30
    classes = components_of(range(len(texts)), [k for k, s in similar.items() if s >= 0.8 - 1e-9])
    got = {r.doc_id: (r.class_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {100 + i: (100 + c, c == i) for i, c in classes.items()}
    assert 40 < len(set(classes.values())) < len(texts) - 30
    stay = minhash.deduplicated(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(100 + c for c in set(classes.values()))


@pytest.mark.parametrize("block", [256, 8])
def test_a_chain_of_texts_that_share_ids(spark, monkeypatch, block):
    """Sixty texts, each one word from the next, two to an id: no link is lost between blocks."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    words = [f"w{k}" for k in range(80)]
    texts = []
    for k in range(60):
        words[k] = f"x{k}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    assert {r.class_id for r in minhash.near_duplicates(docs).collect()} == {0}


@pytest.mark.parametrize("block", [256, 8])
def test_similarities_use_every_frequency(spark, monkeypatch, block):
    """Frequencies too small to be sent to every task count as exactly as the others."""
    rng = random.Random(21)
    texts = []
    for g in range(40):
        # Passages of four to nine documents weigh less than unique ones; pairs beside the limit depend on it.
        base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(rng.randrange(4, 10)):
            text = edited(rng, base, rng.choice([0, 1, 1, 2]))
            texts.append(" ".join(text + [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(8))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    nodes = range(len(texts))
    exact = weighted_similarities(texts)
    expected = components_of(nodes, [k for k, s in exact.items() if s >= 0.8 - 1e-9])
    monkeypatch.setattr(minhash, "HEAVY_SHARE", 64)
    floored = components_of(nodes, [k for k, s in weighted_similarities(texts).items() if s >= 0.8 - 1e-9])
    assert floored != expected
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    monkeypatch.setattr(minhash, "RUN", 500)
    monkeypatch.setattr(minhash, "SLICE_BYTES", 5000)
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == expected


def test_frequencies_equal_counts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HEAVY_SHARE", 100)
    monkeypatch.setattr(minhash, "RUN", 50)
    monkeypatch.setattr(minhash, "SLICE_BYTES", 300)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(30))) for _ in range(80)] + [None, "", "a"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    weights, others, any_ = minhash.shingle_weights(Workspace(spark, "test"), docs)
    bags = [shingle_counter(t or "") for t in texts]
    frequencies = Counter(s for b in bags for s in b)
    heavy = -(-sum(frequencies.values()) // 100)
    assert heavy > 3 and any_
    assert weights.n_docs == len(texts)
    assert sorted(weights.frequencies) == sorted(n for n in frequencies.values() if n >= heavy)
    assert sorted(r.n for r in others.collect()) == sorted(n for n in frequencies.values() if 2 < n < heavy)


def test_classes_of_a_given_table_equal_brute_force(spark):
    """All pairs that share a shingle, on the whole table: recall and precision of the links are 1."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    bags = {i: shingle_counter(t or "") for i, t in rows.items()}
    frequencies = Counter(s for b in bags.values() for s in b)
    top = math.log(len(rows) / 2)
    factor = {s: 1 + math.log(len(rows) / max(n, 2)) / top for s, n in frequencies.items()}
    size = {i: sum(n * factor[s] for s, n in b.items()) for i, b in bags.items()}
    holders = {}
    for i, bag in bags.items():
        for s in bag:
            holders.setdefault(s, []).append(i)
    common = Counter()
    for s, ids in holders.items():
        for i, j in combinations(sorted(ids), 2):
            common[i, j] += min(bags[i][s], bags[j][s]) * factor[s]
    links = [(i, j) for (i, j), c in common.items() if c / (size[i] + size[j] - c) >= 0.8 - 1e-9]
    assert len(links) > 50
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == components_of(rows, links)


def test_repeated_rows_nulls_and_empty_tables(spark):
    long = "a b c d e f g h"
    rows = [(1, long, "s"), (1, long, "s"), (None, long, "s"), (2, long, None), (3, None, "s"), (4, "", "s"), (3, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, text_md5 string")
    got = {(r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (None, None, True), (2, 1, False), (3, 3, True), (4, 4, True)}
    assert sorted(str(r.doc_id) for r in minhash.deduplicated(docs).collect()) == ["1", "3", "4", "None"]
    assert minhash.deduplicated(docs.limit(0)).collect() == []


words = st.lists(st.lists(st.sampled_from("abcdef"), max_size=25).map(" ".join), min_size=1, max_size=9)


@settings(max_examples=100, deadline=None)
@given(words)
def test_exact_similarities(texts):
    elements = minhash.Elements(pa.array(texts), minhash.Weights(1, 2, np.zeros(0, np.uint64), np.zeros(0)))
    got = elements.similarities(np.arange(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        a, b = shingle_counter(texts[i]), shingle_counter(texts[j])
        expected = sum((a & b).values()) / sum((a | b).values()) if a and b else 0
        assert got[i, j] == pytest.approx(expected)


def test_samples_agree_as_often_as_texts_are_similar():
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(edited(rng, base, n)) for n in (0, 5, 15, 40)] * 1
    (chunk,) = word_chunks(pa.array(texts))
    bounds, ids, counts = shingle_counts(chunk, 5)
    weights = minhash.Weights(2, 2, np.zeros(0, np.uint64), np.zeros(0))
    sampled = minhash.samples(bounds, ids, weights.of(ids) * counts)
    for j in (1, 2, 3):
        a, b = shingle_counter(texts[0]), shingle_counter(texts[j])
        similarity = sum((a & b).values()) / sum((a | b).values())
        assert (sampled[0] == sampled[j]).mean() == pytest.approx(similarity, abs=0.15)


def peak_mb(run):
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, peak


def test_counting_and_sampling_take_little_memory():
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 4000))) for _ in range(700)]
    slices = -(-sum(map(len, texts)) // minhash.SLICE_BYTES)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    sent, counting = peak_mb(lambda: [r.to_pydict() for r in minhash._counted_runs(slices)(iter([batch]))])
    # What is sent, about 45 MB, is held here.
    assert counting < 100
    of = [(s, a, c) for r in sent for s, a, c in zip(r["slice"], r["steps"], r["counts"])]
    runs = [pa.table({"steps": [a for s, a, _ in of if s == k], "counts": [c for s, _, c in of if s == k]}) for k in range(slices)]
    added = [peak_mb(lambda k=k: minhash._added_runs(runs[k])) for k in range(slices)]
    assert sum(out["n"][0].as_py() for out, _ in added) == 700 * 3996
    assert max(peak for _, peak in added) < 45
    minhash._sampling_tables.cache_clear()
    assert peak_mb(minhash._sampling_tables)[1] < 80
