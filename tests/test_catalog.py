"""Every registered query against its SQL in DuckDB."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry
from assayframe.catalog import catalog
from compare import compare, connect, rows_of
from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, name) is None


def test_every_query_has_sql():
    assert set(catalog()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["check_name", "column_name", "status"]
    assert df.count() > 10


def test_comparison_sees_differences():
    _, one = rows_of(["b", "a"], [(1, "x"), (2, None)])
    _, two = rows_of(["a", "b"], [("x", 1), (None, 3)])
    assert one != two
    assert one == rows_of(["a", "b"], [(None, 2), ("x", 1)])[1]
