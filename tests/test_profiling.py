"""Profiling operators on small hand-made rows and against brute force."""

import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyframe.operators import profiling, quantiles
from tallyframe.operators.quantiles import numeric_summary


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_missing_counts_null_and_nan(spark):
    df = spark.createDataFrame([(None, None), (1.0, "a"), (float("nan"), "")], "x double, s string")
    assert rows(profiling.missing_counts(df, ["x", "s"])) == [(2, 1)]


def test_column_profile_of_nan_and_null(spark):
    df = spark.createDataFrame([(None, 1, None), (1.0, 3, "b"), (float("nan"), None, "a")], "x double, i int, s string")
    got = {r["column"]: r.asDict() for r in profiling.column_profile(df, ["x", "i"], ["s"]).collect()}
    assert {c: (r["n_rows"], r["count"], r["missing"]) for c, r in got.items()} == {
        "x": (3, 2, 2),
        "i": (3, 2, 1),
        "s": (3, 2, 1),
    }
    assert (got["i"]["mean"], got["i"]["min"], got["i"]["max"], got["i"]["first"]) == (2.0, 1.0, 3.0, None)
    assert (got["s"]["mean"], got["s"]["min"], got["s"]["first"], got["s"]["last"]) == (None, None, "a", "b")


def test_crosstab_drops_null_keys_and_labels_and_fills_zero(spark):
    df = spark.createDataFrame(
        [("M", "a"), ("M", "a"), ("F", "b"), (None, "a"), ("F", None)], "sex string, label string"
    )
    got = sorted(rows(profiling.crosstab(df, "sex", "label", {"a": "a", "b": "b"})))
    assert got == [("F", 0, 1), ("M", 2, 0)]


def test_cells_give_the_direct_results(spark):
    df = spark.createDataFrame(
        [("M", "x", "a"), ("M", "y", "a"), ("F", "x", "b"), (None, "x", "a"), ("F", "y", None)],
        "sex string, work string, label string",
    )
    cells = profiling.category_cells(df, ["sex", "work"], "label")
    of_sex = cells.where("column = 'sex'").drop("column").withColumnRenamed("value", "sex")
    names = {"a": "a", "b": "b"}
    assert sorted(rows(profiling.crosstab(of_sex, "sex", "label", names, weight="n"))) == sorted(
        rows(profiling.crosstab(df, "sex", "label", names))
    )
    assert rows(profiling.label_distribution(of_sex, "label", weight="n")) == [("a", 3), ("b", 1)]
    assert rows(profiling.label_proportions(of_sex, "label", ["a", "zzz"], weight="n")) == [
        ("a", 60.0),
        ("zzz", 0.0),
    ]


def test_label_proportions_count_null_labels_in_the_whole(spark):
    df = spark.createDataFrame([(">50K",), (None,), ("<=50K",), (">50K",)], "label string")
    assert rows(profiling.label_proportions(df, "label", [">50K", "<=50K", "other"])) == [
        (">50K", 50.0),
        ("<=50K", 25.0),
        ("other", 0.0),
    ]


def test_empty_input(spark):
    df = spark.createDataFrame([], "age int, label string")
    assert rows(profiling.label_proportions(df, "label", [">50K"])) == [(">50K", None)]
    assert rows(profiling.row_count(df)) == [(0,)]
    assert rows(profiling.label_check(df, "label")) == [(0, False)]
    assert rows(profiling.schema_listing(df)) == [
        (0, "age", "int", True, 0),
        (1, "label", "string", True, 0),
    ]
    assert rows(numeric_summary(df, ["age"])) == [("age", 0) + (None,) * 7]


def test_label_check_counts_null_as_a_label(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "label string")
    assert rows(profiling.label_check(df, "label")) == [(3, False)]
    assert rows(profiling.label_check(df.dropna(), "label")) == [(2, True)]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "a"), (3, None)], "`x.y` int, `s.t` string")
    assert rows(profiling.describe_numeric(df, ["x.y"]))[0][:3] == ("x.y", 2, 2.0)
    assert rows(profiling.missing_counts(df, ["s.t"])) == [(1,)]
    assert rows(numeric_summary(df, ["x.y"]))[0][0:3] == ("x.y", 2, 2.0)


def expected_summary(values):
    kept = np.array([v for v in values if v is not None and not math.isnan(v)])
    return (
        len(kept),
        float(kept.mean()),
        statistics.stdev(kept.tolist()) if len(kept) > 1 else None,
        float(kept.min()),
        *[float(q) for q in np.quantile(kept, [0.25, 0.5, 0.75])],
        float(kept.max()),
    )


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None) == (w is None), (got, want)
        if g is not None:
            assert g == pytest.approx(w, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("buckets, direct", [(2**18, 2**22), (4, 3), (2, 0), (64, 10)])
def test_numeric_summary_by_brute_force(spark, monkeypatch, buckets, direct):
    """Small limits force many narrowing passes; the results do not change."""
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    monkeypatch.setattr(quantiles, "DIRECT_VALUES", direct)
    rng = np.random.default_rng(7)
    n = 300
    columns = {
        "uniform": rng.uniform(-5, 5, n).tolist(),
        "heavy_tail": (rng.pareto(0.3, n) * rng.choice([-1, 1], n)).tolist(),
        # A third of the rows share one value.
        "hot": [0.25 if i % 3 == 0 else float(v) for i, v in enumerate(rng.normal(size=n))],
        "constant": [4.0] * n,
        "holes": [None if i % 4 == 0 else (math.nan if i % 4 == 1 else float(i)) for i in range(n)],
        "whole_numbers": [float(v) for v in rng.integers(-3, 4, n)],
    }
    df = spark.createDataFrame(
        list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)
    ).repartition(3)
    got = {r[0]: r[1:] for r in rows(numeric_summary(df, list(columns)))}
    for name, values in columns.items():
        same(got[name], expected_summary(values))


def test_numeric_summary_with_extreme_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    monkeypatch.setattr(quantiles, "DIRECT_VALUES", 2)
    inf = float("inf")
    values = [-inf, -1.7e308, -1.0, 0.0, 5e-324, 1e-310, 1.0, 1.7e308, inf]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    (got,) = rows(numeric_summary(df, ["x"], probabilities=(0.0, 0.125, 0.25, 0.5, 0.75, 1.0)))
    assert got[1] == 9
    assert got[5:11] == (-inf, -1.7e308, -1.0, 5e-324, 1.0, inf)


@pytest.mark.parametrize("direct", [0, 6, 1000])
def test_numeric_summary_of_integer_types(spark, monkeypatch, direct):
    monkeypatch.setattr(quantiles, "BUCKETS", 8)
    monkeypatch.setattr(quantiles, "DIRECT_VALUES", direct)
    values = [(i * 37) % 101 - 50 for i in range(90)] + [2, 2, 2, None]
    big = [None if v is None else v * 10**12 for v in values]
    df = spark.createDataFrame(list(zip(values, big, values)), "x int, y bigint, z tinyint")
    got = {r[0]: r[1:] for r in rows(numeric_summary(df, ["x", "y", "z"]))}
    floats = [None if v is None else float(v) for v in values]
    same(got["x"], expected_summary(floats))
    same(got["z"], expected_summary(floats))
    same(got["y"], expected_summary([None if v is None else float(v) for v in big]))


def test_passes_do_not_depend_on_the_spread(spark, monkeypatch):
    """Narrowing scans of log-uniform values over ever wider ranges."""
    split, passes = quantiles._split, []
    monkeypatch.setattr(quantiles, "_split", lambda *args: passes.append(1) or split(*args))
    rng = np.random.default_rng(3)
    for power in (10, 40, 100, 300):
        values = 10.0 ** rng.uniform(-power, power, 20000)
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        passes.clear()
        (got,) = rows(numeric_summary(df, ["x"], direct_values=100))
        assert got[5:8] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]), rel=1e-12)
        assert 1 <= len(passes) <= 3
    # All values next to each other: the most passes there can be.
    close = 1.0 + np.arange(5000) * 2.0**-52
    df = spark.createDataFrame([(float(v),) for v in [*close, -1e300, 1e300]], "x double")
    passes.clear()
    (got,) = rows(numeric_summary(df, ["x"], direct_values=2))
    assert got[5:8] == tuple(np.quantile([*close, -1e300, 1e300], [0.25, 0.5, 0.75]))
    assert len(passes) <= 5


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)), min_size=1, max_size=40))
def test_numeric_summary_integers(spark, values):
    if all(v is None for v in values):
        return
    df = spark.createDataFrame([(v,) for v in values], "x int")
    (got,) = rows(numeric_summary(df, ["x"]))
    same(got[1:], expected_summary([None if v is None else float(v) for v in values]))


@pytest.mark.parametrize("cuts", [[10], [1, 2, 40], [0, 60]])
def test_states_of_parts_merge_to_the_whole(spark, cuts):
    rows = [(None if k % 7 == 0 else k * 1000003 % 89, float(k % 5) if k % 4 else None, "xyz"[k % 3] if k % 11 else None) for k in range(60)]
    schema = "a int, b double, s string"
    whole = profiling.column_profile(spark.createDataFrame(rows, schema), ["a", "b"], ["s"])
    states = None
    for low, high in zip([0, *cuts], [*cuts, 60]):
        state = profiling.profile_state(spark.createDataFrame(rows[low:high], schema), ["a", "b"], ["s"])
        states = state if states is None else profiling.merged_states(states.unionByName(state))
    merged = {r["column"]: r for r in profiling.merged_profile(states).collect()}
    for row in whole.collect():
        got = merged[row["column"]]
        for name in whole.columns:
            assert got[name] == (pytest.approx(row[name]) if isinstance(row[name], float) else row[name]), name


def test_state_of_far_values_keeps_its_deviation(spark):
    """The parts' deviations survive a mean far larger than they are."""
    values = [1e9 + k for k in range(10)]
    parts = [profiling.profile_state(spark.createDataFrame([(v,) for v in p], "v double"), ["v"], []) for p in (values[:3], values[3:])]
    got = profiling.merged_profile(parts[0].unionByName(parts[1])).first()
    assert got["stddev"] == pytest.approx(3.0276503540974917, rel=1e-6)
