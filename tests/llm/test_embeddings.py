"""Linked vectors against all cosines."""

import math
import random

import numpy as np
import pytest

from tallyframe.llm import embeddings
from test_minhash import components_of


def brute(rows):
    """n_links and component of each row by comparing all rows."""
    def good(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = []
    for i, (_, v, lv) in enumerate(rows):
        for j, (_, w, lw) in enumerate(rows[:i]):
            if good(v, lv) and good(w, lw) and lv == lw and len(v) == len(w):
                a, b = np.array(v, np.float64), np.array(w, np.float64)
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.93:
                    links.append((j, i))
    counts = [sum(i in k for k in links) for i in range(len(rows))]
    return counts, components_of(range(len(rows)), links)


def vectors(rng, n, length=16):
    rows = []
    for _ in range(n):
        kind = rng.random()
        if rows and kind < 0.5:
            base = rng.choice(rows)
            v = [x + rng.gauss(0, rng.choice([0, 0.05, 0.2, 0.3])) for x in base[0]]
            rows.append((v, base[1]))
        else:
            rows.append(([rng.gauss(0, 1) for _ in range(length)], rng.randrange(3)))
    out = [[i, [float(np.float32(x)) for x in v], label] for i, (v, label) in enumerate(rows)]
    return [tuple(r) for r in out]


@pytest.mark.parametrize(("bucket", "block"), [(256, 1024), (8, 5)])
def test_links_equal_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(embeddings, "BUCKET", bucket)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = random.Random(2)
    rows = vectors(rng, 220)
    odd = [None, [], [0.0] * 16, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, rows[0][1], None), (2001, [1e-30] * 16, 1), (2002, [1e30] * 16, 1)]
    rows += [(3000 + i, rows[5][1], rows[5][2]) for i in range(20)] + [(2002, [1e30] * 16, 1)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, node string, n int")
    counts, components = brute(rows)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.linked(frame).collect())
    smallest = {}
    for i, c in components.items():
        smallest[c] = min(smallest.get(c, rows[i][0]), rows[i][0])
    expected = sorted((rows[i][0], counts[i], smallest[c], rows[i][0] == smallest[c]) for i, c in components.items())
    assert got == expected
    assert embeddings.linked(frame.limit(0)).collect() == []


def test_null_ids(spark):
    v = [1.0, 2.0, 3.0]
    frame = spark.createDataFrame([(None, v, 1), (7, v, 1), (None, v, 2), (None, None, 1)], "vec_id bigint, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.linked(frame).collect()), key=str)
    assert got == sorted([(None, 1, 7, False), (7, 1, 7, True), (None, 0, None, False), (None, 0, None, False)], key=str)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    for bits in (1, 6, 12):
        a = embeddings.unit(rng.normal(size=(2000, 32)))
        side = embeddings.unit(rng.normal(size=a.shape))
        side = embeddings.unit(side - (side * a).sum(1, keepdims=True) * a)
        b = 0.93 * a + math.sqrt(1 - 0.93**2) * side
        n = embeddings.tables_for(bits, 0.93)
        met = (embeddings.sign_patterns(a, bits, n) == embeddings.sign_patterns(b, bits, n)).any(1)
        assert met.mean() > 0.998
