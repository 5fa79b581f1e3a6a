"""Every query against its expected SQL, both over the same small tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

# The training-data operators have tests of their own.
QUERIES = {name: query for name, query in entry_points.queries().items() if name not in entry_points.LLM_QUERIES}
EXPECTED = {name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "events"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    return value if value is None else str(value)


def contents(table):
    names = sorted(table.column_names)
    columns = [table[name].to_pylist() for name in names]
    return names, sorted((tuple(map(plain, row)) for row in zip(*columns, strict=True)), key=repr)


def types(table):
    """Column types, with only the width of timestamps left out."""
    return {f.name: str(f.type).split("[")[0] for f in table.schema}


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir).toArrow()
    wanted = duck.sql(EXPECTED[name]).to_arrow_table()
    assert contents(found) == contents(wanted)
    assert types(found) == types(wanted)


def test_entry(spark, sf_dir):
    assert "daily_agent_metrics" in QUERIES
    assert entry_points.entry(spark).count() > 0
