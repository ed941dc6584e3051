"""Profiles, missing-value reports and the exploratory summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwise.functions.numeric import exact_sum, round_even

# The week in display order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _distinct(column: str, approximate: bool) -> Column:
    name = F.col(f"`{column}`")
    return F.approx_count_distinct(name) if approximate else F.count_distinct(name)


def profile_retail(raw: DataFrame, columns: int, approximate: bool = False) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(columns).alias("column_count"),
        F.min("InvoiceDate").alias("first_date"),
        F.max("InvoiceDate").alias("last_date"),
        _distinct("Customer ID", approximate).alias("customers"),
        _distinct("StockCode", approximate).alias("products"),
        _distinct("Country", approximate).alias("countries"),
    )


def profile_reviews(raw: DataFrame, columns: int, approximate: bool = False) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(columns).alias("column_count"),
        _distinct("ProductId", approximate).alias("products"),
        _distinct("UserId", approximate).alias("users"),
        F.min("Score").alias("min_score"),
        F.max("Score").alias("max_score"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values, their count and percentage, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    )
    return (
        counts.unpivot("_rows", df.columns, "column_name", "missing_count")
        .where("missing_count > 0")
        .select(
            "column_name",
            "missing_count",
            round_even(F.col("missing_count") / F.col("_rows") * 100, 2).alias("missing_pct"),
        )
    )


def monthly_revenue(retail: DataFrame) -> DataFrame:
    return retail.groupBy(F.date_format("InvoiceDate", "yyyy-MM").alias("month")).agg(
        exact_sum(F.col("TotalSpend")).alias("revenue")
    )


def top_countries(retail: DataFrame, n: int = 10) -> DataFrame:
    return (
        retail.where(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(exact_sum(F.col("TotalSpend")).alias("revenue"))
        .orderBy(F.desc("revenue"), "Country")
        .limit(n)
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    return reviews.where(F.col("Rating").isNotNull()).groupBy("Rating").count().orderBy("Rating")


def lines_by_weekday(retail: DataFrame) -> DataFrame:
    """Lines per weekday for all seven days; a day without lines has a null count."""
    days = retail.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, WEEKDAYS))).alias("position", "Day"))
    counts = retail.groupBy("Day").agg(F.count(F.lit(1)).alias("line_count"))
    return days.join(counts, "Day", "left").select("position", "Day", "line_count").orderBy("position")
