"""Customer survival features, at-risk customers and the Kaplan-Meier estimator."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketwise.functions.labels import spend_segment
from basketwise.functions.numeric import exact_mean, exact_sum, floor_days, percent_where, round_even
from basketwise.operators.ranking import exact_quantiles


def favourite_countries(retail: DataFrame) -> DataFrame:
    """Most frequent country per customer, the first by name where several are.

    Counted per customer and country first: that keeps the aggregation in plain hash tables, where a
    mode next to the distinct counts would sort every line three times.
    """
    counts = retail.where(F.col("Country").isNotNull()).groupBy("Customer ID", "Country").agg(
        F.count(F.lit(1)).alias("lines")
    )
    best = F.min(F.struct((-F.col("lines")).alias("less"), "Country")).alias("best")
    return counts.groupBy("Customer ID").agg(best).select("Customer ID", F.col("best.Country").alias("favourite_country"))


def survival_features(retail: DataFrame, churn_days: int = 90) -> DataFrame:
    """One row per customer: purchase history, duration, churn flag and purchase rate.

    ``avg_order_value`` is the mean spend per line.
    """
    last_day = retail.agg(F.max("InvoiceDate").alias("last_day")).scalar()
    history = retail.groupBy("Customer ID").agg(
        F.min("InvoiceDate").alias("first_purchase"),
        F.max("InvoiceDate").alias("last_purchase"),
        F.count_distinct("Invoice").alias("total_orders"),
        exact_sum(F.col("TotalSpend")).alias("total_spend"),
        F.sum("Quantity").alias("total_items"),
        F.count_distinct("StockCode").alias("unique_products"),
        exact_mean(F.col("TotalSpend")).alias("avg_order_value"),
    )
    days = history.join(favourite_countries(retail), "Customer ID", "left").withColumns(
        {
            "duration": floor_days(F.col("first_purchase"), F.col("last_purchase")),
            "days_since_last": floor_days(F.col("last_purchase"), last_day),
        }
    )
    # months come from the unclipped duration; only then is the duration raised to one day
    rates = days.withColumns(
        {
            "churned": (F.col("days_since_last") > churn_days).cast("int"),
            "tenure_months": F.greatest(F.col("duration") / 30, F.lit(0.1)),
        }
    )
    return rates.withColumn("purchase_frequency", F.col("total_orders") / F.col("tenure_months")).withColumn(
        "duration", F.greatest("duration", F.lit(1).cast("long"))
    )


def survival_segments(features: DataFrame) -> DataFrame:
    """Adds the spend segment: top quarter, above the median, the rest."""
    cuts = exact_quantiles(features, ["total_spend"], [0.5, 0.75])

    def cut(p: float):
        return F.max(F.when(F.col("probability") == p, F.col("quantile")))

    row = cuts.agg(F.struct(cut(0.5).alias("median"), cut(0.75).alias("upper")).alias("cuts")).scalar()
    return (
        features.withColumn("_c", row)
        .withColumn("segment", spend_segment(F.col("total_spend"), F.col("_c.median"), F.col("_c.upper")))
        .drop("_c")
    )


def churn_summary(features: DataFrame) -> DataFrame:
    churned = F.col("churned") == 1
    return features.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(churned).alias("churned_customers"),
        F.count_if(~churned).alias("active_customers"),
        percent_where(churned).alias("churn_rate_pct"),
        percent_where(~churned).alias("active_rate_pct"),
        exact_mean(F.col("duration")).alias("avg_duration"),
        exact_mean(F.col("total_spend")).alias("avg_spend"),
        exact_mean(F.col("total_orders")).alias("avg_orders"),
    )


def at_risk_customers(features: DataFrame, first_day: int = 60, last_day: int = 90) -> DataFrame:
    """Customers still active but quiet for 60 to 90 days, with a risk score."""
    score = (
        F.col("days_since_last") / last_day * 0.5
        + (1 / F.greatest(F.col("total_orders").cast("double"), F.lit(1.0))) * 0.3
        + (1 / F.greatest(F.col("total_spend"), F.lit(1.0))) * 0.2
    )
    return features.where((F.col("churned") == 0) & F.col("days_since_last").between(first_day, last_day)).withColumn(
        "risk_score", round_even(score, 4)
    )


def by_risk(at_risk: DataFrame, n: int | None = None) -> DataFrame:
    ordered = at_risk.orderBy(F.desc("risk_score"), "Customer ID")
    return ordered if n is None else ordered.limit(n)


def retention_case(at_risk: DataFrame, retained: float = 0.30) -> DataFrame:
    spend = at_risk.agg(
        F.count(F.lit(1)).alias("at_risk_customers"), exact_mean(F.col("total_spend")).alias("avg_spend")
    )
    revenue = F.col("at_risk_customers") * F.col("avg_spend")
    return spend.select(
        "at_risk_customers",
        "avg_spend",
        revenue.alias("revenue_at_risk"),
        (revenue * retained).alias("revenue_saved"),
    )


def kaplan_meier(
    df: DataFrame,
    by: Sequence[str] = (),
    duration: str = "duration",
    event: str = "churned",
    alpha: float = 0.05,
) -> DataFrame:
    """Product-limit survival curve with log-log Greenwood bounds, one row per distinct time.

    Rows are counted per stratum and time first. Times are whole days, so what the windows order is
    bounded by the days the data spans and does not grow with the number of customers.
    """
    z = NormalDist().inv_cdf(1 - alpha / 2)
    keys = list(by)
    table = df.groupBy(*keys, F.col(duration).alias("time")).agg(
        F.sum(F.col(event).cast("long")).alias("events"), F.count(F.lit(1)).alias("leaving")
    )
    frame = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    later = frame.orderBy(F.desc("time"))
    earlier = frame.orderBy("time")
    n, d, s = F.col("at_risk"), F.col("events"), F.col("survival")
    steps = table.withColumn("at_risk", F.sum("leaving").over(later)).withColumns(
        {
            "survival": F.product(1 - d / n).over(earlier),
            "hazard_var": F.sum(F.when(n > d, d / (n * (n - d)))).over(earlier),
        }
    )
    # the bounds are 1 before the first event and undefined once nobody is left
    shift = F.lit(z) * F.sqrt("hazard_var") / F.ln(s)

    def bound(sign: int):
        return F.when(s == 1, 1.0).when(s > 0, F.exp(-F.exp(F.ln(-F.ln(s)) + F.lit(float(sign)) * shift)))

    return steps.select(
        *keys,
        "time",
        "at_risk",
        "events",
        (F.col("leaving") - d).alias("censored"),
        "survival",
        bound(-1).alias("ci_lower"),
        bound(1).alias("ci_upper"),
    )


def survival_at_times(curve: DataFrame, times: Sequence[int] = (90, 180, 365)) -> DataFrame:
    """Value of the step function at given times (1 before the first step)."""
    values = [
        F.struct(
            F.lit(t).alias("time"),
            F.coalesce(
                F.max_by("survival", F.when(F.col("time") <= t, F.col("time"))).cast("double"), F.lit(1.0)
            ).alias("survival"),
        )
        for t in times
    ]
    return curve.agg(F.array(*values).alias("v")).select(F.inline("v"))


def median_survival(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First time at which survival is one half or less; infinite if it never is."""
    crossed = F.min(F.when(F.col("survival") <= 0.5, F.col("time")))
    value = F.coalesce(crossed.cast("double"), F.lit(float("inf"))).alias("median_survival")
    return curve.groupBy(*by).agg(value) if by else curve.agg(value)
