"""Queries of the training-data operators against DuckDB on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from basketwise.llm.registry import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_registered():
    assert QUERIES.keys() <= queries().keys()
    assert ORACLES.keys() <= oracle_sql().keys()
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES if name.startswith("op")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
