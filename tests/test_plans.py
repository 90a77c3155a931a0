"""The end-to-end flow, and what the physical plans of the registered queries may contain."""

import re

import pytest

import __spark_entry__ as contract
from tallyframe import sources as src
from tallyframe.operators.model import ModelParams
from tallyframe.plans import run_analysis, score_with_saved
from tallyframe.plans.analysis import label_column_names
from tallyframe.sources.people import spread
from conftest import DATA
from test_model import NEW_ROWS, census

SF_DIR = f"{DATA}/sf0.001"
PLANNED = sorted(contract.core_queries())


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_plans_hold_at_scale(spark, name):
    plan = physical(contract.core_queries()[name](spark, SF_DIR))
    for operator in ("PythonUDF", "InPandas", "MapPartitions", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan, operator
    # A global sort or an exchange into one task may only follow an aggregation.
    for exchange in re.finditer(r"^(.*)Exchange SinglePartition", plan, re.M):
        below = plan[exchange.end() :].lstrip("\n").splitlines()
        assert any("Aggregate" in line for line in below[:6]), plan


def test_scans_are_pruned(spark):
    reads = {
        "crosstab_sex": {"l_linestatus", "l_extendedprice", "l_discount", "l_partkey", "p_partkey", "p_size"},
        "label_check": {"l_extendedprice", "l_discount"},
        "index_workclass": {"l_returnflag"},
        "row_count": set(),
        "confusion_matrix": {"l_quantity", "l_returnflag", "l_extendedprice", "l_discount"},
    }
    for name, expected in reads.items():
        plan = physical(contract.core_queries()[name](spark, SF_DIR))
        got = {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<(.*?)>", plan) for c in s.split(",") if c}
        assert got == expected, name


def test_metrics_of_one_table_take_one_scan(spark):
    for name in ("weighted_metrics", "binary_metrics", "confidence_bands", "prediction_summary"):
        plan = physical(contract.core_queries()[name](spark, SF_DIR))
        assert plan.count("FileScan") == 1, name


def test_a_large_table_is_not_spread(spark):
    scan = spark.range(0, 1000, 1, numPartitions=64)
    assert spread(scan) is scan
    few = spark.range(0, 1000, 1, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_full_analysis(spark, tmp_path):
    training, scoring = str(tmp_path / "training"), str(tmp_path / "scoring")
    src.stage_csv(spark.createDataFrame(census(), src.LABELLED_SCHEMA), training)
    src.stage_csv(spark.createDataFrame(NEW_ROWS, src.FEATURE_SCHEMA), scoring)
    out = run_analysis(spark, training, scoring, str(tmp_path / "out"), ModelParams(max_iter=10))

    rows = census()
    assert out["row_count"].first()[0] == len(rows)
    counts = {r["label"]: r["count"] for r in out["label_distribution"].collect()}
    assert counts == {v: sum(r[6] == v for r in rows) for v in (">50K", "<=50K")}
    cross = {r["sex"]: (r["gt_50k"], r["le_50k"]) for r in out["crosstab_sex"].collect()}
    assert cross == {
        s: tuple(sum(r[1] == s and r[6] == v for r in rows) for v in (">50K", "<=50K")) for s in ("Male", "Female")
    }
    assert out["label_check"].first()["is_binary"]
    assert {r["column"]: r["missing"] for r in out["missing"].collect()} == dict.fromkeys(src.LABELLED_SCHEMA.names, 0)
    ages = [r[0] for r in rows]
    described = {r["column"]: r for r in out["describe_numeric"].collect()}["age"]
    assert (described["count"], described["min"], described["max"]) == (len(rows), min(ages), max(ages))
    assert {r["column"] for r in out["describe_string"].collect()} == {"sex", "workclass", "education", "label"}
    assert out["head_rows"].count() == 10 and out["prediction_sample"].count() == 20
    assert out["new_predictions"].count() == 20
    counts = {r["table"]: r["n_rows"] for r in out["table_counts"].collect()}
    assert counts == {"training_rows": len(rows), "scoring_rows": 20, "new_predictions": 20}
    listing = out["schema_listing"].orderBy("position").collect()
    assert [(r["column"], r["filled"]) for r in listing] == [(c, len(rows)) for c in src.LABELLED_SCHEMA.names]
    assert out["metrics_report"].count() == 8 and out["confidence_bands"].count() == 3
    assert sum(out["confusion_matrix"].first()) == len(rows)
    assert out["prediction_summary"].agg({"count": "sum"}).first()[0] == len(rows)
    assert out["class1_probability_summary"].first()["n"] == len(rows)
    assert out["coefficients"].count() == 3 * 15


def test_held_out_metrics_rejected_rows_and_a_saved_model(spark, tmp_path):
    training, scoring, root = (str(tmp_path / name) for name in ("training.csv", "scoring", "models"))
    rows = census()
    header = ",".join(src.LABELLED_SCHEMA.names)
    lines = [",".join(map(str, r)) for r in rows] + ["30,Male,Gov,1,Masters,forty,>50K", "30,Male"]
    (tmp_path / "training.csv").write_text("\n".join([header, *lines]) + "\n")
    src.stage_csv(spark.createDataFrame(NEW_ROWS, src.FEATURE_SCHEMA), scoring)
    params = ModelParams(max_iter=10, numeric_handle_invalid="skip")
    out = run_analysis(spark, training, scoring, str(tmp_path / "out"), params, held_out=0.25, model_root=root)

    faults = {(r["cause"], r["column"]): r["n"] for r in out["training_rows_faults"].collect()}
    assert faults == {("unreadable", "hours_per_week"): 1, ("short", None): 1}
    assert out["training_rows_rejected"].count() == 2 and out["scoring_rows_rejected"].count() == 0
    seen, unseen = (out[f"{part}outcome_cells"].agg({"n": "sum"}).first()[0] for part in ("", "held_out_"))
    assert abs(unseen - len(rows) / 4) <= 2 and seen + unseen == len(rows)
    assert 0 <= out["held_out_binary_metrics"].first()["accuracy"] <= 1
    sizes = [sum(out[name].first()[:2]) for name in ("train_ranking", "held_out_ranking")]
    assert sizes == [seen, unseen]
    again = score_with_saved(spark, root, scoring, str(tmp_path / "later"))
    ours, theirs = again["new_predictions"], out["new_predictions"]
    assert ours.exceptAll(theirs).isEmpty() and ours.count() == 20 and again["scoring_rows_faults"].count() == 0


def test_profile_is_written_even_if_the_fit_is_refused(spark, tmp_path):
    training, out = str(tmp_path / "training"), str(tmp_path / "out")
    one_class = [(*r[:6], "<=50K") for r in census()]
    src.stage_csv(spark.createDataFrame(one_class, src.LABELLED_SCHEMA), training)
    with pytest.raises(ValueError, match="needs 2 label values"):
        run_analysis(spark, training, "unused", out)
    assert not spark.read.parquet(f"{out}/label_check").first()["is_binary"]
    assert spark.read.parquet(f"{out}/crosstab_sex").columns == ["sex", "le_50k"]


def test_profile_is_written_without_any_label(spark, tmp_path):
    training, out = str(tmp_path / "training"), str(tmp_path / "out")
    src.stage_csv(spark.createDataFrame([(*r[:6], None) for r in census()], src.LABELLED_SCHEMA), training)
    with pytest.raises(ValueError):
        run_analysis(spark, training, "unused", out)
    for name in ("schema_listing", "numeric_summary", "label_distribution", "label_proportions", "crosstab_education"):
        spark.read.parquet(f"{out}/{name}").count()
    assert spark.read.parquet(f"{out}/row_count").first()[0] == len(census())


def test_label_column_names():
    assert label_column_names(["<=50K", ">50K", "a b", "a-b", "?"]) == {
        "<=50K": "le_50k",
        ">50K": "gt_50k",
        "a b": "a_b",
        "a-b": "a_b_3",
        "?": "label",
    }
