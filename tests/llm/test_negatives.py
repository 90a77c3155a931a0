"""Hard negatives against all inner products, in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, is_anchor, scale=256, most=2**25):
    valid = [
        (i, v, [max(-most, min(most - 1, math.floor(scale * x))) for x in e], label)
        for i, (v, e, label) in enumerate(rows)
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, anchor_id, a, label in valid:
        if anchor_id is None or not is_anchor(anchor_id):
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, b)), math.inf if v is None else v, other == label)
            for j, v, b, other in valid
            if i != j and len(a) == len(b)
        ]
        scored.sort(key=lambda s: s[:2])
        for positive, positive_id, _ in [s for s in scored if s[2]][:5]:
            near = [s for s in scored if not s[2] and 80 * -positive <= 100 * -s[0] <= 100 * -positive][:5]
            for rank, (score, negative_id, _) in enumerate(near, 1):
                ids = (None if k == math.inf else k for k in (positive_id, negative_id))
                out.append((anchor_id, next(ids), rank, next(ids), -positive, -score))
    return sorted(out, key=str)


def test_lookups_are_inner_products():
    rng = np.random.default_rng(1)
    for bits, length in ((1, 3), (2, 8), (9, 64), (26, 21)):
        edge = 1 << (bits - 1)
        a, c = (rng.integers(-edge, edge, (n, length)) for n in (7, 40))
        planes = negatives.packed_planes(c, bits)
        assert (negatives.unpacked(planes)[:, :length] == c).all()
        tables = negatives.subset_sums(negatives.unpacked(negatives.packed_planes(a, bits)))
        assert (negatives.looked_up(tables, planes) == c @ a.T).all()


def table_of(rng, n, length=11):
    rows = []
    for _ in range(n):
        if rows and rng.random() < 0.6:
            base = rng.choice(rows)
            v = [float(np.float32(x + rng.choice([0, 0, 0.02, 0.2]) * rng.gauss(0, 1))) for x in base[1]]
        else:
            v = [float(np.float32(rng.gauss(0, 0.4))) for _ in range(length)]
        rows.append((rng.choice([rng.randrange(n), len(rows)]), v, rng.randrange(3)))
    return rows


@pytest.mark.parametrize(("anchors", "stripe", "held", "at_once"), [(1 << 14, 256, 64, 1024), (7, 16, 3, 5)])
def test_equal_brute_force(spark, monkeypatch, anchors, stripe, held, at_once):
    for name, value in (("ANCHORS", anchors), ("STRIPE", stripe), ("LEAST_STRIPE", stripe), ("HELD", held), ("AT_ONCE", at_once)):
        monkeypatch.setattr(negatives, name, value)
    rng = random.Random(5)
    rows = table_of(rng, 200)
    rows += [(None, rows[3][1], 1), (None, rows[3][1], 2), (6, None, 1), (12, [], 1), (18, [], 2), (24, [None] * 11, 1)]
    rows += [(30, [math.nan] * 11, 0), (36, [math.inf] * 11, 0), (42, [0.0] * 11, 1), (48, rows[0][1], None), (54, [1.0, 2.0], 1), (60, [1.0, 1.9], 2)]
    rows += [(66, [1e30] * 11, 1), (72, [9e29] * 11, 0), (78, [-1e30] * 11, 0)]
    rows += [(1000 + k, rows[8][1], rows[8][2]) for k in range(30)] + [(84, rows[8][1], (rows[8][2] + 1) % 3)] * 9
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, `row` string, low int").repartition(3)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 6 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, lambda v: v % 6 == 0)


def test_no_anchors_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA)
    assert negatives.hard_negatives(frame, F.lit(False)).collect() == []
    assert negatives.hard_negatives(frame, F.lit(None).cast("boolean")).collect() == []
    assert negatives.hard_negatives(frame.limit(0), F.lit(True)).collect() == []
    with pytest.raises(ValueError, match="dimensions"):
        negatives.hard_negatives(spark.createDataFrame([(1, [0.5] * 5000, 1)], SCHEMA), F.lit(True))


def test_label_types_and_a_third_of_rows_alike(spark):
    rows = [(k, [0.5, float(k % 5)], "ab"[k % 2]) for k in range(60)] + [(600, [0.5, 1.0], "a")] * 40
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    got = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, lambda v: v % 10 == 0)
