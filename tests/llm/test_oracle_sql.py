"""Queries that SQL can express, against their SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from credmill.llm import registry

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query(spark, sf_dir, name):
    tables = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        tables.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = tables.sql(registry.oracle_sql()[name])
    found = registry.queries()[name](spark, sf_dir)
    assert {c: TYPES[kind] for c, kind in found.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    rows = sorted(str(tuple(row[c] for c in expected.columns)) for row in found.collect())
    assert rows == sorted(map(str, expected.fetchall()))
