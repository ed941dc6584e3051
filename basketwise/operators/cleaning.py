"""Cleaning of order lines and reviews, with the row counts after every step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _invoice() -> Column:
    # a missing invoice number is kept, as the text 'nan'
    return F.coalesce(F.col("Invoice").cast("string"), F.lit("nan"))


def _retail_steps() -> list[tuple[str, Column]]:
    # plain comparisons on stored columns, so that they reach the scan; NaN sorts above every number
    customer, invoice = F.col("`Customer ID`"), F.col("Invoice")
    return [
        ("null customer", customer.isNotNull() & ~F.isnan(customer.cast("double"))),
        ("cancelled", invoice.isNull() | ~invoice.cast("string").startswith("C")),
        ("quantity not positive", F.col("Quantity") > 0),
        ("price not positive", (F.col("Price") > 0) & ~F.isnan("Price")),
    ]


def clean_retail(raw: DataFrame) -> DataFrame:
    """Identified, uncancelled lines with positive quantity and price, plus spend and date parts."""
    kept = raw
    for _, rule in _retail_steps():
        kept = kept.where(rule)
    when = F.col("InvoiceDate").cast("timestamp")
    return kept.withColumns(
        {
            "Invoice": _invoice(),
            "StockCode": F.col("StockCode").cast("string"),
            "InvoiceDate": when,
            "Customer ID": F.col("Customer ID").cast("long"),
            "TotalSpend": F.col("Quantity") * F.col("Price"),
            "Year": F.year(when),
            "Month": F.month(when),
            "Day": F.date_format(when, "EEEE"),
        }
    )


def _funnel(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts c0..cn as rows (step, stage, rows, removed)."""
    steps = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("stage"),
                F.col(f"c{i}").alias("rows"),
                (F.col("c0") - F.col(f"c{i}")).alias("removed"),
            )
            for i, name in enumerate(names)
        ]
    )
    return counts.select(F.inline(steps))


def retail_funnel(raw: DataFrame) -> DataFrame:
    """Rows left after each cleaning step and rows removed so far, in one pass."""
    steps = _retail_steps()
    passed = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("c0")]
    for i, (_, rule) in enumerate(steps, 1):
        passed = passed & F.coalesce(rule, F.lit(False))
        aggs.append(F.count_if(passed).alias(f"c{i}"))
    return _funnel(raw.agg(*aggs), ["raw", *[name for name, _ in steps]])


def _first_per(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    first = Window.partitionBy(*keys).orderBy(ordinal)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def clean_reviews(raw: DataFrame, ordinal: str = "Id") -> DataFrame:
    """Reviews with text and summary; of several by one user on one product the first stays."""
    kept = raw.dropna(subset=["Text", "Summary"])
    return _first_per(kept, ["UserId", "ProductId"], ordinal).select(
        "ProductId",
        "UserId",
        F.col("Score").alias("Rating"),
        "Summary",
        "Text",
        "Time",
        F.timestamp_seconds("Time").alias("ReviewDate"),
        F.length("Text").alias("ReviewLength"),
        F.col(ordinal).alias("ordinal"),
    )


def reviews_funnel(raw: DataFrame) -> DataFrame:
    has_text = F.col("Text").isNotNull() & F.col("Summary").isNotNull()
    pair = F.struct("UserId", "ProductId")
    counts = raw.agg(
        F.count(F.lit(1)).alias("c0"),
        F.count_if(has_text).alias("c1"),
        F.count_distinct(F.when(has_text, pair)).alias("c2"),
    )
    return _funnel(counts, ["raw", "null text", "duplicate"])
