"""CSV reading, staging, the people tables, and sinks."""

import pytest

import __spark_entry__ as contract
from tallyframe import sources as src
from tallyframe.operators import evaluation, report
from conftest import DATA

HEADER = "age,sex,workclass,fnlwgt,education,hours_per_week,label"


def read(spark, tmp_path, *lines):
    path = tmp_path / "people.csv"
    path.write_text("\n".join(lines) + "\n")
    return [tuple(r) for r in src.read_labelled(spark, str(path)).collect()]


def test_columns_bind_by_position(spark, tmp_path):
    shuffled = "label,age,sex,workclass,fnlwgt,education,hours_per_week"
    assert read(spark, tmp_path, shuffled, "30,Male,Private,1,HS-grad,40,>50K") == [
        (30, "Male", "Private", 1, "HS-grad", 40, ">50K")
    ]


def test_unparsable_numbers_become_null(spark, tmp_path):
    bad = ["3x", "30.5", "NaN", "99999999999", ""]
    got = read(spark, tmp_path, HEADER, *[f"{b},Male,Private,1,HS-grad,40,>50K" for b in bad])
    assert [r[0] for r in got] == [None] * len(bad)
    assert all(r[1:] == ("Male", "Private", 1, "HS-grad", 40, ">50K") for r in got)


def test_empty_strings_become_null_and_spaces_stay(spark, tmp_path):
    got = read(spark, tmp_path, HEADER, '30,,"",1, Male ,40,>50K')
    assert got == [(30, None, None, 1, " Male ", 40, ">50K")]


def test_short_long_and_blank_lines(spark, tmp_path):
    got = read(spark, tmp_path, HEADER, "30,Male", "", "31,Male,Gov,1,11th,40,>50K,extra,more")
    assert got == [(30, "Male", None, None, None, None, None), (31, "Male", "Gov", 1, "11th", 40, ">50K")]


def test_staged_table_equals_its_source(spark):
    path = f"{src.shared_folder(spark)}/staging-test"
    people = src.people(spark, f"{DATA}/sf0.001")
    staged = src.stage_parquet(people, path)
    assert staged.count() == people.count()
    assert staged.exceptAll(people).isEmpty()
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_people_skips_the_join_it_does_not_need(spark):
    plan = src.people(spark, f"{DATA}/sf0.001", ["sex", "label"])._jdf.queryExecution().toString()
    assert "Join" not in plan
    assert src.people(spark, f"{DATA}/sf0.001").count() == 6000


def test_report_sink(spark, tmp_path):
    cells = spark.createDataFrame([(0.0, 0.0, 3), (1.0, 1.0, 1)], "label_indexed double, prediction double, n long")
    out = report.metrics_report(cells)
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        assert report.write_report(out, path, fmt)
        back = spark.read.schema(out.schema).option("header", True).format(fmt).load(path)
        assert back.exceptAll(out).isEmpty() and back.count() == 8


def test_empty_report_leaves_no_earlier_rows(spark, tmp_path):
    cells = spark.createDataFrame([(0.0, 0.0, 3)], "label_indexed double, prediction double, n long")
    nothing = report.metrics_report(evaluation.confusion_counts(spark.createDataFrame([], "label_indexed double, prediction double")))
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / f"report-{fmt}")
        assert report.write_report(report.metrics_report(cells), path, fmt)
        assert report.write_report(nothing, path, fmt) is False
        assert spark.read.schema(nothing.schema).option("header", True).format(fmt).load(path).isEmpty()


def test_a_cluster_needs_the_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        applicationId, master = "app", "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        src.shared_folder(Session())
    Context.master = "local[2]"
    assert src.shared_folder(Session()).endswith("tallyframe-app")


def test_two_data_folders_stay_readable(spark):
    for name in ("typed_csv_scan", "scoring_scan", "metrics_report"):
        first = contract.queries()[name](spark, f"{DATA}/sf0.001")
        second = contract.queries()[name](spark, f"{DATA}/sf0.01")
        assert first.count() == (8 if name == "metrics_report" else 6000)
        assert second.count() == (8 if name == "metrics_report" else 60000)


def test_rows_that_do_not_parse(spark, tmp_path):
    """Every fault a line can have, with the columns at fault; rows without fault are not listed."""
    lines = [
        "age,sex,workclass,fnlwgt,education,hours_per_week,label",
        "30,Male,Gov,1,Masters,40,>50K",
        "3x,Male,Gov,1,Masters,40,>50K",
        "30.5,Male,Gov,99999999999,Masters,NaN,>50K",
        ",,,,,,",
        "30,Male,Gov,1,Masters,40",
        "3x",
        "30,Male,Gov,1,Masters,40,>50K,",
        "x,Male,Gov,1,Masters,40,>50K,more,and more",
        '30," Male","Gov, or not",1,"",40,>50K',
        "",
    ]
    path = tmp_path / "people.csv"
    path.write_text("\n".join(lines) + "\n")
    rows, rejected = src.read_checked(spark, str(path), src.LABELLED_SCHEMA, str(tmp_path / "rows"))
    plain = src.read_labelled(spark, str(path))
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty() and rows.count() == 9
    found = {r["raw_line"]: [tuple(f) for f in r["faults"]] for r in rejected.collect()}
    assert found == {
        lines[2]: [("unreadable", "age")],
        lines[3]: [("unreadable", "age"), ("unreadable", "fnlwgt"), ("unreadable", "hours_per_week")],
        lines[5]: [("short", None)],
        lines[6]: [("short", None), ("unreadable", "age")],
        lines[7]: [("long", None)],
        lines[8]: [("long", None), ("unreadable", "age")],
    }
    counts = {(r["cause"], r["column"]): r["n"] for r in src.fault_counts(rejected).collect()}
    assert counts[("unreadable", "age")] == 4 and counts[("long", None)] == counts[("short", None)] == 2
