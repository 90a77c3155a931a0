"""Every registered query against its SQL, run by another engine on the same files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import DATA

SF_DIR = os.environ.get("ORACLE_SF_DIR", f"{DATA}/sf0.001")
QUERIES, SQL = contract.core_queries(), contract.core_oracle_sql()
ROWS_ONLY = {
    "model_coefficients",
    "score_training",
    "score_stages",
    "prediction_sample",
    "score_new",
    "train_report",
    "held_out_report",
    "cross_validation",
}


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row]
    return sorted(([row[i] for i in order] for row in rows), key=key)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


# Equivalent type names of the two engines (fixed values).
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def test_every_query_without_sql_is_declared():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.sql(SQL[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in ours.schema.fields} == {
        c: str(t) for c, t in zip(theirs.columns, theirs.types)
    }
    expected = comparable(theirs.columns, theirs.fetchall())
    got = comparable(ours.columns, [tuple(r) for r in ours.collect()])
    assert got == expected
    assert got


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    people = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    expected = {
        "model_coefficients": 3 * 15,
        "score_training": people,
        "score_stages": people,
        "prediction_sample": 20,
        "score_new": people,
        "train_report": 8,
        "held_out_report": 8,
        "cross_validation": 6,
    }
    assert df.count() == expected[name]
