"""Every registered query against its SQL, by value and by type."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

# The subpackage's queries, where they are installed, have tests of their own.
OTHERS = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in contract.queries().items() if not OTHERS.match(name)}
ORACLE = contract.oracle_sql()
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "float": "FLOAT", "date": "DATE",
}


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == {name for name in ORACLE if not OTHERS.match(name)}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, tables, name):
    df = QUERIES[name](spark, sf_dir)
    expected = tables.sql(ORACLE[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    order = sorted(df.columns)
    places = [expected.columns.index(column) for column in order]
    actual = sorted(repr(tuple(row[column] for column in order)) for row in df.collect())
    wanted = sorted(
        repr(tuple(row[place] for place in places)) for row in expected.fetchall()
    )
    assert actual == wanted


def test_entry(spark, sf_dir):
    rows = {r.credit_grade: r.members for r in contract.entry(spark).collect()}
    assert rows == {"very_good": 53, "good": 88, "medium": 147, "bad": 111, "very_bad": 165}
