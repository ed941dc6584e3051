"""Global ranks, exact quantiles and describe, without a one-partition window.

Values are first counted per distinct value, so that a value held by many rows costs one row.
The distinct values are then cut into ranges at approximate quantiles, and each of these again at its
own; each range is ranked on its own and shifted by the count of all lower ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketwise.functions.numeric import exact_mean, round_even


def ranked_values(df: DataFrame, columns: Sequence[str], ranges: int = 128) -> DataFrame:
    """Distinct values of some numeric columns with their rank.

    Gives (metric, value, ties, max_rank, total): ``max_rank`` is the number of rows up to and
    including the value, ``total`` the number of rows with a value in that column.
    """
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "metric", "value"
    )
    counts = (
        long.where(F.col("value").isNotNull()).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("ties"))
    )
    placed = range_of_value(counts, ranges)
    lower = Window.partitionBy("metric").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("metric", "range")
        .agg(F.sum("ties").alias("size"))
        .select(
            "metric",
            "range",
            F.coalesce(F.sum("size").over(lower), F.lit(0)).alias("before"),
            F.sum("size").over(Window.partitionBy("metric")).alias("total"),
        )
    )
    within = Window.partitionBy("metric", "range").orderBy("value")
    return (
        placed.withColumn("inside", F.sum("ties").over(within))
        .join(offsets, ["metric", "range"])
        .select("metric", "value", "ties", (F.col("before") + F.col("inside")).alias("max_rank"), "total")
    )


def range_of_value(values: DataFrame, ranges: int = 128) -> DataFrame:
    """Adds ``range`` to rows (metric, value, ...): about ``ranges`` squared ranges of rising values, each with like many rows.

    The first cut is as exact as an approximate quantile of all rows, which may be off by more than a range of the second; so
    the ranges are cut again by quantiles of their own rows.
    """
    probabilities = [i / ranges for i in range(1, ranges)]
    below = lambda edges: F.size(F.filter(edges, lambda e: e < F.col("value")))
    first = values.groupBy("metric").agg(F.percentile_approx("value", probabilities).alias("edges"))
    # one row per named column, each with `ranges` numbers
    once = values.join(F.broadcast(first), "metric").withColumn("range", below("edges")).drop("edges")
    second = once.groupBy("metric", "range").agg(F.percentile_approx("value", probabilities).alias("edges"))
    # `ranges` rows per named column, each with `ranges` numbers
    return once.join(F.broadcast(second), ["metric", "range"]).withColumn("range", F.col("range") * ranges + below("edges")).drop("edges")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, as (metric, probability, quantile)."""
    spots = ranked_values(df, columns).select(
        "*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    )
    spot = F.col("probability") * (F.col("total") - 1)

    def value_at(position):
        held = (F.col("max_rank") - F.col("ties") <= position) & (position < F.col("max_rank"))
        return F.max(F.when(held, F.col("value")))

    return (
        spots.groupBy("metric", "probability")
        .agg(
            value_at(F.floor(spot)).alias("low"),
            value_at(F.ceil(spot)).alias("high"),
            F.max(spot - F.floor(spot)).alias("part"),
        )
        .select(
            "metric",
            "probability",
            (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("quantile"),
        )
    )


def describe(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "metric", "value"
    )
    moments = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        round_even(exact_mean(F.col("value")), digits).alias("mean"),
        round_even(F.stddev_samp("value"), digits).alias("std"),
        round_even(F.min("value"), digits).alias("min"),
        round_even(F.max("value"), digits).alias("max"),
    )
    # three rows per metric, so the pivot keeps one row per named column
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quartiles = exact_quantiles(df, columns, list(names)).groupBy("metric")
    wide = quartiles.agg(
        *[
            round_even(F.max(F.when(F.col("probability") == p, F.col("quantile"))), digits).alias(name)
            for p, name in names.items()
        ]
    )
    return moments.join(wide, "metric")
