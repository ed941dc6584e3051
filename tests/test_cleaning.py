from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketwise.operators import cleaning, profiling
from basketwise.sinks import writers
from basketwise.sources import readers
from basketwise.sources.schemas import RETAIL_RAW, REVIEWS_RAW, conform

NOON = datetime(2021, 3, 1, 12)


def _lines(spark, rows):
    return conform(spark.createDataFrame(rows, RETAIL_RAW), RETAIL_RAW)


@pytest.fixture
def lines(spark):
    nan = float("nan")
    return _lines(
        spark,
        [
            ("1", "A", "x", 2, NOON, 1.5, 7.0, "UK"),
            (None, "A", "x", 1, NOON, 1.0, 7.0, "UK"),
            ("C2", "A", "x", 1, NOON, 1.0, 7.0, "UK"),
            ("c3", "A", "x", 1, NOON, 1.0, 7.0, "UK"),
            ("4", "A", "x", 1, NOON, 1.0, None, "UK"),
            ("5", "A", "x", 1, NOON, 1.0, nan, "UK"),
            ("6", "A", "x", 0, NOON, 1.0, 7.0, "UK"),
            ("7", "A", "x", 1, NOON, nan, 7.0, "UK"),
            ("8", "A", "x", 1, NOON, 0.0, 7.0, "UK"),
        ],
    )


def test_clean_retail_keeps_missing_invoices_and_drops_nan(lines):
    rows = cleaning.clean_retail(lines).orderBy("Invoice").collect()
    assert [r["Invoice"] for r in rows] == ["1", "c3", "nan"]
    first = rows[0]
    assert (first["TotalSpend"], first["Year"], first["Month"], first["Day"]) == (3.0, 2021, 3, "Monday")
    assert first["Customer ID"] == 7


def test_funnel_agrees_with_the_cleaning(lines):
    rows = cleaning.retail_funnel(lines).orderBy("step").collect()
    counts = [r["rows"] for r in rows]
    assert counts == [9, 7, 6, 5, 3]
    assert counts[-1] == cleaning.clean_retail(lines).count()
    assert [r["removed"] for r in rows] == [9 - c for c in counts]


def test_first_review_of_a_pair_wins_and_null_keys_are_equal(spark):
    rows = [
        (3, "P", "U", 1, "s", "late", 0),
        (1, "P", "U", 2, "s", "early", 0),
        (2, None, "U", 3, "s", "null one", 0),
        (4, None, "U", 4, "s", "null two", 0),
        (0, "P", "U", 5, None, "no summary", 0),
    ]
    raw = spark.createDataFrame(rows, REVIEWS_RAW)
    kept = cleaning.clean_reviews(raw).orderBy("ordinal").collect()
    assert [r["Text"] for r in kept] == ["early", "null one"]
    assert [r["rows"] for r in cleaning.reviews_funnel(raw).orderBy("step").collect()] == [5, 4, 2]


def test_review_length_counts_code_points(spark):
    raw = spark.createDataFrame([(1, "P", "U", 1, "s", "café \U0001f600", 86400)], REVIEWS_RAW)
    row = cleaning.clean_reviews(raw).first()
    assert row["ReviewLength"] == 6
    assert row["ReviewDate"] == datetime(1970, 1, 2)


def test_csv_missing_texts_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "Id,ProductId,UserId,Score,Summary,Text,Time\n"
        '1,P,U,5,"say ""hi"", ok","two\nlines",10\n'
        "2,NA,null,4,N/A,None,\n"
    )
    rows = readers.read_reviews_csv(spark, str(path)).orderBy("Id").collect()
    assert rows[0]["Summary"] == 'say "hi", ok' and rows[0]["Text"] == "two\nlines"
    assert rows[1].asDict() == dict(
        Id=2, ProductId=None, UserId=None, Score=4, Summary=None, Text=None, Time=None
    )


def test_csv_round_trip(spark, lines, tmp_path):
    writers.write_csv(lines, str(tmp_path / "out"))
    back = readers.read_csv(spark, str(tmp_path / "out"), RETAIL_RAW)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, lines.collect()))


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="Country"):
        conform(spark.createDataFrame([("1",)], "Invoice string"), RETAIL_RAW)


def test_union_keeps_repeated_rows(lines):
    swapped = lines.select(*reversed([f"`{c}`" for c in lines.columns]))
    assert readers.union_parts(lines, swapped).count() == 18


def test_missing_values_lists_only_columns_with_gaps(lines):
    got = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in profiling.missing_values(lines).collect()}
    assert got == {"Invoice": (1, 11.11), "Price": (1, 11.11), "Customer ID": (2, 22.22)}


def test_weekdays_without_lines_stay(lines):
    rows = profiling.lines_by_weekday(cleaning.clean_retail(lines)).collect()
    assert [r["Day"] for r in rows] == profiling.WEEKDAYS
    assert [r["line_count"] for r in rows] == [3] + [None] * 6


def test_publish_cleans_names_and_counts(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "`Customer ID` long, `a-b` long")
    counts = writers.publish({"t": df}, spark, "publish_test", str(tmp_path / "db"))
    assert [tuple(r) for r in counts.collect()] == [("t", 1)]
    assert readers.catalog_table(spark, "publish_test.t").columns == ["Customer_ID", "a_b"]
    assert spark.sql("SHOW TABLES IN publish_test").where(F.col("tableName") == "t").count() == 1


def test_cleaning_rules_and_columns_reach_the_scan(spark, lines, tmp_path):
    writers.write_parquet(lines, str(tmp_path / "lines"))
    stored = readers.read_table(spark, str(tmp_path / "lines"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = profiling.monthly_revenue(cleaning.clean_retail(stored))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    pushed, read = scan.split("PushedFilters:")[1].split("ReadSchema:")
    for rule in ("GreaterThan(Quantity,0)", "GreaterThan(Price,0.0)", "StringStartsWith(Invoice,C)", "Customer ID"):
        assert rule in pushed
    assert "Description" not in read and "Country" not in read
