"""ROC figures against all pairs, and running totals against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import ranking, running

SCHEMA = "label_indexed double, probability array<double>"


def brute(rows):
    known = [(y, p[1] if len(p) > 1 else p[0]) for y, p in rows if y in (0.0, 1.0) and p and p[-1] is not None and p[-1] == p[-1]]
    ones, zeros = ([s for y, s in known if y == k] for k in (1.0, 0.0))
    if not ones or not zeros:
        return len(ones), len(zeros), None, None, None, None
    auc = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / len(ones) / len(zeros)
    precision = ks = 0.0
    best = None
    for t in sorted({s for _, s in known}, reverse=True):
        tp, fp = sum(s >= t for s in ones), sum(s >= t for s in zeros)
        precision += ones.count(t) * tp / (tp + fp) / len(ones)
        distance = abs(tp / len(ones) - fp / len(zeros))
        if distance > ks + 1e-12:
            ks, best = distance, t
    return len(ones), len(zeros), auc, precision, ks, best


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_equals_all_pairs(spark, digits):
    rng = random.Random(digits)
    rows = []
    for _ in range(400):
        y = rng.choice([0.0, 1.0, 1.0, 2.0, None])
        s = round(min(1.0, max(0.0, rng.gauss(0.4 + 0.1 * (y or 0.0), 0.2))), digits)
        rows.append((y, rng.choice([[1 - s, s]] * 9 + [[s], None])))
    frame = spark.createDataFrame([*rows, (1.0, [0.1, float("nan")])], SCHEMA).repartition(7)
    points = ranking.roc_points(frame)
    got = tuple(ranking.roc_summary(points).first())
    assert got == pytest.approx(brute(rows), abs=1e-9)
    counted = points.orderBy(F.desc("threshold")).collect()
    assert (counted[-1]["tp"], counted[-1]["fp"]) == got[:2]


def test_one_class_and_no_rows(spark):
    frame = spark.createDataFrame([(1.0, [0.5, 0.5]), (1.0, [0.2, 0.8])], SCHEMA)
    assert tuple(ranking.roc_summary(ranking.roc_points(frame)).first()) == (2, 0, None, None, None, None)
    assert tuple(ranking.roc_summary(ranking.roc_points(frame.limit(0))).first()) == (0, 0, None, None, None, None)


def test_positive_class_may_be_the_first(spark):
    rows = [(0.0, [0.9, 0.1]), (1.0, [0.3, 0.7]), (1.0, [0.95, 0.05])]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert ranking.roc_summary(ranking.roc_points(frame, positive=0)).first()["auc"] == 0.5


def test_running_totals(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abcdef"), k, rng.randrange(-5, 9)) for k in rng.sample(range(5000), 900)]
    frame = spark.createDataFrame(rows, "a string, k int, n bigint").repartition(6)
    got = running.with_running_totals(frame, [F.desc("a"), F.asc("k")], {"upto": "n"})
    total, expected = 0, []
    for a, k, n in sorted(rows, key=lambda r: (-ord(r[0]), r[1])):
        total += n
        expected.append((a, k, n, total))
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_no_task_sorts_everything(spark):
    """Single-task exchanges carry one row per range only."""
    frame = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("n"))
    plan = running.with_running_totals(frame, [F.asc("k")], {"upto": "n"})._jdf.queryExecution().executedPlan().toString()
    after = plan[plan.index("SinglePartition") :]
    assert "HashAggregate" in after and plan.count("SinglePartition") == 1
