"""The cube method and the targets, against direct computations."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tallyframe.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Targets by repeated resharing; ``sizes`` in source order."""
    total, target, full = sum(sizes), [0.0] * len(sizes), set()
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    while True:
        left = total - sum(cap * sizes[i] for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        for i in open_:
            target[i] = left * weight[i] / sum(weight[j] for j in open_)
        over = [i for i in open_ if target[i] > cap * sizes[i]]
        if not over:
            return [cap * s if i in full else target[i] for i, s in enumerate(sizes)]
        full.update(over)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 50), st.floats(0, 0.999)), max_size=40))
def test_move_keeps_both_sums(units):
    chance, size, draws = ([u[i] for u in units] for i in range(3))
    moved = mixing.move(chance, size, draws)
    assert all(0 <= x <= 1 for x in moved)
    assert sum(1e-8 < x < 1 - 1e-8 for x in moved) <= 2
    assert sum(moved) == pytest.approx(sum(chance), abs=1e-6)
    assert sum(x * s for x, s in zip(moved, size)) == pytest.approx(sum(x * s for x, s in zip(chance, size)), abs=1e-4)
    assert set(mixing.land(moved, size)) <= {0.0, 1.0} | {x for x in moved if x in (0, 1)}


def test_moves_keep_each_chance_on_average():
    rng = random.Random(5)
    chance, size = [0.2, 0.5, 0.9, 0.4], [3, 10, 4, 7]
    runs = [mixing.move(chance, size, [rng.random() for _ in chance]) for _ in range(20000)]
    for k, x in enumerate(chance):
        assert sum(r[k] for r in runs) / len(runs) == pytest.approx(x, abs=0.02)


SCHEMA = "doc_id bigint, text string, source string, size string, target int, taken double, block int"


def rows_of(spec):
    """``spec``: (source, word counts)."""
    out, i = [], 0
    for source, counts in spec:
        for n in counts:
            out.append((i, " \t".join(["w"] * n) if n is not None else None, source, "x", 1, 2.0, 3))
            i += 1
    return out


def test_mix(spark):
    rng = random.Random(1)
    spec = [
        ("b", [rng.randint(1, 40) for _ in range(2500)]),  # several blocks
        ("a", [rng.randint(1, 9) for _ in range(30)]),  # takes three copies of each
        (None, [rng.randint(0, 60) for _ in range(700)] + [None]),
        ("é", [0, 0]),
        ("c", [5] * 400),
    ]
    docs = spark.createDataFrame(rows_of(spec), SCHEMA)
    got = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(docs.count()))
    order = ["a", "b", "c", "é", None]
    sizes = [sum(n or 0 for n in dict(spec)[s]) for s in order]
    for source, size, target in zip(order, sizes, brute_targets(sizes)):
        own = [r for r in got if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert all(r.target == pytest.approx(target) for r in own)
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in own)
        assert abs(sum(r.taken for r in own) - target) <= max((r.size for r in own), default=0)
        if size:
            assert abs(sum(r.copies for r in own) - target / size * len(own)) <= 2
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b", None)] * 5 + [(1, "c", "s")] * 5, "doc_id bigint, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == 10 and all(0 <= r.copies <= 3 for r in got)
    assert mixing.mix(docs.limit(0)).collect() == []
    nothing = mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, "b")], docs.schema)).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in nothing) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 100), min_size=1, max_size=7))
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(chr(97 + i), s) for i, s in enumerate(sizes)], "source string, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    for i, target in enumerate(brute_targets(sizes)):
        assert got[chr(97 + i)] == pytest.approx(target, abs=1e-9)


def test_sources_land_near_their_targets(spark):
    """Within the smallest documents' sizes, though some documents hold a hundredth of their source."""
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), F.when(F.col("id") % 97 == 0, 900).otherwise(3 + F.col("id") % 41).cast("int")).alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"),
    )
    for row in mixing.mix(docs).groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("taken")).collect():
        assert abs(row["taken"] - row["target"]) <= max(4, 0.002 * row["target"])


def test_a_third_of_the_rows_under_one_id(spark, monkeypatch):
    """Blocks stay near BLOCK rows, and repeated rows are all there."""
    monkeypatch.setattr(mixing, "BLOCK", 100)
    sizes = []
    dealt = mixing._round

    def seen(rows, salt, last):
        if not salt:
            blocks = F.greatest(F.ceil(F.col("n_docs") / mixing.BLOCK), F.lit(1))
            key = F.pmod(F.xxhash64("order", "spread", F.lit(salt)), blocks)
            sizes.extend(r["count"] for r in rows.groupBy("source", key).count().collect())
        return dealt(rows, salt, last)

    monkeypatch.setattr(mixing, "_round", seen)
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("a b")).otherwise(F.concat(F.lit("a "), F.col("id"))).alias("text"),
        F.lit(None).cast("string").alias("source"),
    )
    got = mixing.mix(docs)
    assert got.count() == 6000 and got.where("doc_id = 7").count() == 2001
    assert max(sizes) < 3 * mixing.BLOCK
