"""Rounding, exact money sums, whole-day differences and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def round_even(value: Column, digits: int) -> Column:
    """Round a double half to even after scaling, as numpy and pandas do."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def exact_sum(value: Column, scale: int = 4) -> Column:
    """Sum doubles as decimals, so that the order of the rows cannot change the result."""
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


def exact_mean(value: Column, scale: int = 4) -> Column:
    return exact_sum(value, scale) / F.nullif(F.count(value), F.lit(0))


def percent_where(condition: Column) -> Column:
    """Percentage of rows of a group that meet a condition (null counts as not met)."""
    return F.count_if(condition) * F.lit(100.0) / F.nullif(F.count(F.lit(1)), F.lit(0))


def floor_days(earlier: Column, later: Column) -> Column:
    """Whole 24-hour periods between two timestamps, rounded down."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(float(MICROS_PER_DAY))).cast("long")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram whose last bin is closed on both sides.

    Gives every bin (empty ones too) with its edges, its count and the overall mean.
    """
    value = F.col(column).cast("double")
    stats = df.agg(
        F.min(value).alias("low"), F.max(value).alias("high"), exact_mean(value).alias("mean")
    )
    spread = stats.select(F.struct("low", "high", "mean")).scalar()
    placed = df.select(value.alias("value")).where(F.col("value").isNotNull()).withColumn("s", spread)
    counts = (
        placed.withColumn(
            "bin",
            F.when(F.col("s.low") == F.col("s.high"), F.lit(bins // 2 + 1)).otherwise(
                F.least(F.expr(f"width_bucket(value, s.low, s.high, {bins})").cast("int"), F.lit(bins))
            ),
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # a constant column gets a unit-wide range around its value
    flat = F.col("low") == F.col("high")
    low = F.when(flat, F.col("low") - 0.5).otherwise(F.col("low"))
    high = F.when(flat, F.col("high") + 0.5).otherwise(F.col("high"))
    frame = stats.select(
        low.alias("low"),
        ((high - low) / F.lit(float(bins))).alias("width"),
        "mean",
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("width") * (F.col("bin") - 1)).alias("bin_start"),
        (F.col("low") + F.col("width") * F.col("bin")).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.col("mean").alias("mean_value"),
    )
