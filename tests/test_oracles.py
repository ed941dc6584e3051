"""Queries against DuckDB on the smallest tables; ORACLE_ALL=1 runs every one, ORACLE_DIR picks another folder."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
SOME = [
    "retail_union", "reviews_csv_roundtrip", "retail_clean", "reviews_clean", "rfm_describe", "rfm_segments", "survival_segments",
    "kaplan_meier_by_segment", "cox_features", "top_neighbours_popular_split", "recommendations", "sentiment_scores",
    "word_freq_negative", "master_customers", "segment_summary_rfm", "dash_sentiment_bands",
]
NAMES = sorted(oracle_sql()) if os.environ.get("ORACLE_ALL") else SOME

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"SELECT {listed} FROM ({oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_entry_gives_the_segments(spark):
    rows = entry(spark).collect()
    assert {r["RFM_Segment"] for r in rows} == {"Champions", "Loyal Customers", "At Risk", "Lost"}
