"""Line dedup against a plain count; plans without Python."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import lines
from tallyframe.llm import queries as llm
from test_oracle import SF_DIR


def brute_lines(rows, ratio, least):
    """Kept text of each (site, text)."""
    total = Counter(site for site, _ in rows)
    pages = Counter((site, line) for site, text in rows for line in {x.strip(" ") for x in (text or "").split("\n")} if line)
    gone = {k for k, n in pages.items() if n >= least and n > ratio * total[k[0]]}
    return [
        None if text is None else "\n".join(x for x in text.split("\n") if (site, x.strip(" ")) not in gone) for site, text in rows
    ]


ROWS = [
    ("a", "menu\nfirst story\n\n menu "),
    ("a", "menu\nsecond story"),
    ("a", "menu"),
    ("a", "menu\nfirst story"),
    ("b", "menu\nonly two"),
    ("b", "menu\nonly two"),
    (None, "menu\nx"),
    (None, "menu\ny"),
    (None, "menu"),
    ("c", None),
    ("c", ""),
    ("c", "\n\n"),
]


@pytest.mark.parametrize("ratio", [0.1, 0.5, 0.9, 1.0])
def test_lines_equal_brute_force(spark, ratio):
    rows = [(i, s, t, "x", 1, len(t or "")) for i, (s, t) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, "doc_id int, source string, text string, site string, kept_text int, n_chars int")
    got = lines.lines_deduplicated(docs, ratio)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    by_id = {r.doc_id: r for r in got.collect()}
    expected = brute_lines(ROWS, ratio, lines.MIN_PAGES)
    assert [by_id[i].text for i in range(len(ROWS))] == expected
    assert all(r.n_chars == len(r.text or "") and r.site == "x" for r in by_id.values())
    assert lines.lines_deduplicated(docs.limit(0)).collect() == []


def test_counts_and_hosts(spark):
    pages = spark.createDataFrame(ROWS, "host string, page string")
    got = lines.without_boilerplate(pages, F.col("host"), F.col("page"), 0.5)
    first = next(r for r in got.collect() if r.page == ROWS[0][1])
    assert (first.kept_text, first.n_lines, first.n_dropped) == ("first story\n", 4, 2)
    urls = [("https://User@Www.Example.com:8080/a?b", "www.example.com"), ("no url", None), (None, None), ("http://x", "x")]
    frame = spark.createDataFrame([(u,) for u, _ in urls], "u string").select(lines.url_host(F.col("u")))
    assert [r[0] for r in frame.collect()] == [h for _, h in urls]


@pytest.mark.parametrize("name", ["op1_chat_format", "op10_line_dedup"])
def test_native_plans(spark, name):
    plan = llm.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_columns_that_clash_stay(spark):
    pages = spark.createDataFrame([(1, "s", "a\nb", "mine", -1)], "page_id int, site string, page string, kept_text string, N_Lines int")
    (row,) = lines.without_boilerplate(pages, F.col("site"), F.col("page")).collect()
    assert (row["kept_text"], row["N_Lines"]) == ("mine", -1)
    assert (row["kept_text_"], row["n_lines_"], row["n_dropped"]) == ("a\nb", 2, 0)
