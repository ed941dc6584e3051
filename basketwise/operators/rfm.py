"""Recency, frequency and spend per customer, their scores and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwise.functions.labels import quintile, rfm_segment
from basketwise.functions.numeric import exact_mean, exact_sum, floor_days, round_even
from basketwise.operators.ranking import ranked_values

METRICS = ["Recency", "Frequency", "Monetary"]


def rfm_metrics(retail: DataFrame) -> DataFrame:
    last_day = retail.agg(F.max("InvoiceDate").alias("last_day")).scalar()
    return (
        retail.groupBy(F.col("Customer ID").alias("CustomerID"))
        .agg(
            F.max("InvoiceDate").alias("last_purchase"),
            F.count_distinct("Invoice").alias("Frequency"),
            exact_sum(F.col("TotalSpend")).alias("Monetary"),
        )
        .select(
            "CustomerID",
            floor_days(F.col("last_purchase"), last_day).alias("Recency"),
            "Frequency",
            "Monetary",
        )
    )


def _score_edges(metrics: DataFrame) -> DataFrame:
    """One row with, per metric and score 2 to 5, the value from which that score is reached.

    Scores are monotone in the value, so these twelve numbers place every customer without a
    join back on the ranked values.
    """
    share = (F.col("max_rank") - (F.col("ties") - 1) / 2) / F.col("total")
    reverse = F.col("metric") == "Recency"
    scored = ranked_values(metrics, METRICS).select(
        "metric", "value", quintile(F.when(reverse, 1 - share).otherwise(share)).alias("score")
    )
    edges = []
    for metric in METRICS:
        pick = F.max if metric == "Recency" else F.min
        for score in range(2, 6):
            reached = (F.col("metric") == metric) & (F.col("score") >= score)
            edges.append(pick(F.when(reached, F.col("value"))).alias(f"{metric}_{score}"))
    return scored.agg(*edges)


def rfm_scores(metrics: DataFrame) -> DataFrame:
    """Scores 1 to 5 by average percentile rank; for recency fewer days score higher."""
    edges = _score_edges(metrics)
    placed = metrics.withColumn("_e", edges.select(F.struct(*edges.columns)).scalar())
    for metric in METRICS:
        score = F.lit(1)
        for level in range(2, 6):
            edge = F.col(f"_e.{metric}_{level}")
            reached = F.col(metric) <= edge if metric == "Recency" else F.col(metric) >= edge
            score = score + F.coalesce(reached, F.lit(False)).cast("int")
        placed = placed.withColumn(f"{metric[0]}_Score", score)
    return placed.drop("_e").withColumn("RFM_Score", F.col("R_Score") + F.col("F_Score") + F.col("M_Score"))


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn("RFM_Segment", rfm_segment(F.col("RFM_Score")))


def value_shares(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Rows per label and their percentage of all labelled rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.select(column, "count", round_even(F.col("count") / total * 100, digits).alias("percentage"))


def segment_avg_revenue(segments: DataFrame, label: str) -> DataFrame:
    return (
        segments.groupBy(label)
        .agg(exact_mean(F.col("Monetary")).alias("avg_revenue"))
        .orderBy(F.desc("avg_revenue"), label)
    )


def rfm_scaled(metrics: DataFrame) -> DataFrame:
    """Z-scores with the population deviation; a constant column becomes zero."""
    moments = metrics.agg(
        *[F.avg(m).alias(f"{m}_mean") for m in METRICS],
        *[F.stddev_pop(m).alias(f"{m}_std") for m in METRICS],
    )
    placed = metrics.withColumn("_m", moments.select(F.struct(*moments.columns)).scalar())
    scaled = [
        (
            (F.col(m) - F.col(f"_m.{m}_mean"))
            / F.when(F.col(f"_m.{m}_std") == 0, 1.0).otherwise(F.col(f"_m.{m}_std"))
        ).alias(f"{m}_z")
        for m in METRICS
    ]
    return placed.select("CustomerID", *scaled)
