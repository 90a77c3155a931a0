"""Every registered query of the package: its SQL on another engine, or at least its contract's columns."""

import pytest

import __spark_entry__ as contract
from tallyframe.llm import queries as llm
from test_oracle import SF_DIR, TYPES, comparable, duck  # noqa: F401

SQL = llm.oracle_sql()


def test_registered():
    assert set(llm.queries()) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in llm.queries()} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):  # noqa: F811
    ours = llm.queries()[name](spark, SF_DIR)
    theirs = duck.sql(SQL[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in ours.schema.fields} == {
        c: str(t) for c, t in zip(theirs.columns, theirs.types)
    }
    got = comparable(ours.columns, [tuple(r) for r in ours.collect()])
    assert got == comparable(theirs.columns, theirs.fetchall())
    assert got
