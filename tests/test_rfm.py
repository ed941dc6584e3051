import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketwise.operators import ranking, rfm


@pytest.fixture(scope="module")
def customers():
    rng = random.Random(5)
    return pd.DataFrame(
        {
            "CustomerID": range(500),
            # a third of all customers share one value
            "Recency": [3 if i % 3 == 0 else rng.randrange(400) for i in range(500)],
            "Frequency": [rng.choice([1, 1, 1, 2, 3, 8]) for _ in range(500)],
            "Monetary": [round(rng.expovariate(0.001), 2) for _ in range(500)],
        }
    )


def _score(values, lower_is_better):
    """Quintile of the average percentile rank, from how many values are smaller and how many equal."""
    smaller = (values[None, :] < values[:, None]).sum(axis=1)
    equal = (values[None, :] == values[:, None]).sum(axis=1)
    share = (smaller + (equal + 1) / 2) / len(values)
    if lower_is_better:
        share = 1 - share
    return 1 + sum((share > edge).astype(int) for edge in (0.2, 0.4, 0.6, 0.8))


@pytest.mark.parametrize("partitions", [1, 7])
def test_scores_equal_ranked_quintiles(spark, customers, partitions):
    df = spark.createDataFrame(customers).repartition(partitions)
    got = rfm.rfm_segments(rfm.rfm_scores(df)).toPandas().sort_values("CustomerID", ignore_index=True)
    for metric in rfm.METRICS:
        expected = _score(customers[metric].to_numpy().astype(float), metric == "Recency")
        assert got[f"{metric[0]}_Score"].tolist() == expected.tolist()
    assert got["RFM_Score"].between(3, 15).all()


@pytest.mark.parametrize("ranges", [2, 16])
def test_ranked_values_equal_pandas_ranks(spark, customers, ranges):
    df = spark.createDataFrame(customers)
    got = ranking.ranked_values(df, rfm.METRICS, ranges=ranges).toPandas()
    for metric in rfm.METRICS:
        part = got[got.metric == metric].set_index("value")["max_rank"]
        expected = customers[metric].rank(method="max")
        assert part.loc[customers[metric].astype(float)].tolist() == expected.tolist()


def test_exact_quantiles_equal_numpy(spark, customers):
    df = spark.createDataFrame(customers)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    for r in ranking.exact_quantiles(df, rfm.METRICS, probabilities).collect():
        assert r["quantile"] == pytest.approx(np.quantile(customers[r["metric"]], r["probability"]), rel=1e-12)


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1, 5, 2, 3.0)], "CustomerID long, Recency long, Frequency long, Monetary double")
    row = rfm.rfm_scores(one).first()
    assert (row["R_Score"], row["F_Score"], row["M_Score"]) == (1, 5, 5)
    assert ranking.exact_quantiles(one, ["Monetary"], [0.5]).first()["quantile"] == 3.0
    assert rfm.rfm_scores(one.where("false")).count() == 0


def test_scaling_uses_the_population_deviation(spark, customers):
    z = rfm.rfm_scaled(spark.createDataFrame(customers)).toPandas()
    assert np.allclose(z[["Recency_z", "Frequency_z", "Monetary_z"]].std(ddof=0), 1)
    flat = spark.createDataFrame([(1, 5, 2, 3.0), (2, 5, 2, 3.0)], "CustomerID long, Recency long, Frequency long, Monetary double")
    assert rfm.rfm_scaled(flat).agg(F.sum("Recency_z")).first()[0] == 0.0


def test_ranges_stay_small(spark):
    """Half of all distinct values lie in a millionth of the scale, and a few are huge."""
    n = 400_000
    values = spark.range(n).select(F.lit("x").alias("metric"), F.when(F.col("id") % 2 == 0, F.col("id") / 1e12).otherwise(F.exp(F.col("id") / n * 300)).alias("value"))
    placed = ranking.range_of_value(values, ranges=16)
    sizes = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("range").collect()
    assert len(sizes) >= 200 and max(r["n"] for r in sizes) < 2 * n / 16**2
    assert all(a["high"] < b["low"] for a, b in zip(sizes, sizes[1:]))
