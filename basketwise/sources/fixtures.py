"""Adapters that shape the test tables like order lines and product reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwise.sources.readers import read_table, spread, union_parts
from basketwise.sources.schemas import RETAIL_RAW, REVIEWS_RAW, conform

SPLIT_DATE = "1998-05-01"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return read_table(spark, f"{sf_dir}/{name}.parquet")

    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    quantity = (
        F.when(cancelled, -F.col("l_quantity"))
        .when((F.col("l_linenumber") == 7) & (F.col("l_discount") == 0), 0)
        .otherwise(F.col("l_quantity"))
    )
    free = (F.col("l_linenumber") == 1) & (F.col("l_tax") == 0.08)
    ordered = F.col("o_orderdate").cast("timestamp")
    return (
        spread(table("lineitem"), "l_orderkey", "l_partkey")
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.when(cancelled, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias("Invoice"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.col("p_name").alias("Description"),
            quantity.cast("int").alias("Quantity"),
            F.timestamp_micros(F.unix_micros(ordered) + F.col("o_orderkey") % 1440 * 60_000_000).alias("InvoiceDate"),
            F.when(free, 0.0).otherwise(F.col("p_retailprice")).alias("Price"),
            F.when(F.col("o_orderkey") % 20 != 0, F.col("o_custkey").cast("double")).alias("Customer ID"),
            F.col("n_name").alias("Country"),
            F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("ordinal"),
            (ordered >= F.lit(SPLIT_DATE).cast("timestamp")).alias("late"),
        )
    )


def retail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with an ``ordinal`` that stands for the order of the file."""
    return conform(_lines(spark, sf_dir).drop("late"), RETAIL_RAW)


def retail_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = _lines(spark, sf_dir)
    return lines.where(~F.col("late")).drop("late"), lines.where(F.col("late")).drop("late")


def retail_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(union_parts(*retail_parts(spark, sf_dir)), RETAIL_RAW)


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    df = spread(read_table(spark, f"{sf_dir}/documents.parquet"), "doc_id").select(
        doc.alias("Id"),
        F.concat(F.lit("P"), (F.col("n_chars") % 150).cast("string")).alias("ProductId"),
        F.concat(F.lit("U"), (doc % 40).cast("string")).alias("UserId"),
        (F.col("n_chars") % 5 + 1).cast("int").alias("Score"),
        F.when(doc % 50 != 0, F.substring_index("text", ".", 1)).alias("Summary"),
        F.when(doc % 97 != 0, F.col("text")).alias("Text"),
        (F.lit(1_041_379_200) + doc % 450 * 86_400).alias("Time"),
    )
    return conform(df, REVIEWS_RAW)
