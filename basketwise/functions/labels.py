"""Business labels as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spend_segment(spend: Column, median: Column, upper: Column) -> Column:
    return (
        F.when(spend >= upper, "High Value").when(spend >= median, "Medium Value").otherwise("Low Value")
    )


def sentiment_class(compound: Column, cut: float = 0.05) -> Column:
    return F.when(compound >= cut, "Positive").when(compound <= -cut, "Negative").otherwise("Neutral")


def quintile(share: Column) -> Column:
    """1 to 5 for a share in [0, 1]; each fifth includes its upper edge."""
    return (
        F.when(share <= 0.2, 1)
        .when(share <= 0.4, 2)
        .when(share <= 0.6, 3)
        .when(share <= 0.8, 4)
        .when(share <= 1.0, 5)
    )


def rfm_segment(score: Column) -> Column:
    return (
        F.when(score >= 13, "Champions")
        .when(score >= 10, "Loyal Customers")
        .when(score >= 7, "At Risk")
        .otherwise("Lost")
    )


def short_label(text: Column, width: int = 30) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def sentiment_band(score: Column) -> Column:
    """Four bands of a mean score; no score falls in the last."""
    steps = [(0.5, "Very Positive"), (0.05, "Positive"), (-0.05, "Neutral")]
    reached = [F.when(score >= least, name) for least, name in steps]
    return F.coalesce(*reached, F.lit("Negative"))
