"""Stratified parts: exact sizes, the same rows on every run, repeated rows on both sides of a cut."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import folds

SCHEMA = "x int, y string, label string"


def table(rng, n):
    hot = (7, "same", "a")
    return [hot if rng.random() < 0.3 else (rng.choice([None, rng.randrange(n)]), rng.choice(["p", None]), rng.choice(["a", "b", "b", None])) for _ in range(n)]


def sizes(rows, shares):
    out = Counter()
    for label, n in Counter(r[2] for r in rows).items():
        ends = [math.floor(n * math.fsum(shares[: k + 1]) + 0.5) for k in range(len(shares) - 1)] + [n]
        for k, (low, high) in enumerate(zip([0, *ends], ends)):
            if high > low:
                out[label, k] = high - low
    return dict(out)


@pytest.mark.parametrize("shares", [[0.8, 0.2], [0.1] * 10, [0.0, 1.0], [1.0], [0.5, 0.0, 0.5], [0.999, 0.001]])
@pytest.mark.parametrize("direct", [2**16, 4])
def test_exact_shares(spark, monkeypatch, shares, direct):
    monkeypatch.setattr(folds, "DIRECT_ROWS", direct)
    rows = table(random.Random(len(shares)), 700)
    frame = spark.createDataFrame(rows, SCHEMA)
    first = [tuple(r) for r in folds.with_fold(frame.repartition(3), "label", shares).collect()]
    assert Counter(r[:3] for r in first) == Counter(rows)
    assert dict(Counter((r[2], r[3]) for r in first)) == sizes(rows, shares)
    again = folds.with_fold(frame.orderBy("y").repartition(8), "label", shares).collect()
    assert Counter(first) == Counter(map(tuple, again))


def test_seed_and_columns(spark):
    frame = spark.range(2000).select(F.col("id").alias("x"), (F.col("id") % 2).alias("label"))
    parts = [{r["x"] for r in folds.with_fold(frame, "label", [0.5, 0.5], seed).where("fold = 1").collect()} for seed in (0, 1)]
    assert len(parts[0]) == len(parts[1]) == 1000 and 300 < len(parts[0] & parts[1]) < 700
    wide = frame.withColumn("noise", F.rand())
    by_id = {r["x"] for r in folds.with_fold(wide, "label", [0.5, 0.5], columns=["x", "label"]).where("fold = 1").collect()}
    assert by_id == parts[0]


def test_odd_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert folds.with_fold(empty, "label", [0.5, 0.5]).collect() == []
    with pytest.raises(ValueError, match="add up"):
        folds.with_fold(empty, "label", [0.5, 0.6])
    with pytest.raises(ValueError, match="fold"):
        folds.with_fold(empty.withColumn("fold", F.lit(1)), "label", [1.0])


def test_held_out_split(spark):
    frame = spark.createDataFrame(table(random.Random(1), 500), SCHEMA)
    training, rest = folds.held_out_split(frame, "label", 0.25)
    assert training.columns == rest.columns == frame.columns
    assert training.count() + rest.count() == 500
    assert training.union(rest).exceptAll(frame).isEmpty()
