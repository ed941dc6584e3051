from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from basketwise.functions import labels, text
from basketwise.functions.numeric import exact_sum, floor_days, histogram, round_even


def test_round_even_matches_numpy(spark):
    values = [0.125, 0.375, 2.675, -0.125, 1.005, 12345.6785]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_even(F.col("v"), 2)).collect()]
    assert got == np.round(values, 2).tolist()


def test_floor_days_counts_whole_periods(spark):
    rows = [
        (datetime(2020, 1, 1, 23), datetime(2020, 1, 2, 1)),
        (datetime(2020, 1, 1, 1), datetime(2020, 1, 2, 1)),
        (datetime(2020, 1, 2, 1), datetime(2020, 1, 1, 23)),
    ]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp")
    assert [r[0] for r in df.select(floor_days(F.col("a"), F.col("b"))).collect()] == [0, 1, -1]


def test_exact_sum_ignores_row_order(spark):
    values = [0.1] * 10 + [1e9, -1e9]
    for order in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(3)
        assert df.agg(exact_sum(F.col("v"))).first()[0] == 1.0


def test_histogram_matches_numpy(spark):
    values = [1.0, 1.5, 2.0, 2.0, 3.0, 9.0, 11.0]
    rows = histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", 5).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=5)
    assert [r["count"] for r in rows] == counts.tolist()
    assert np.allclose([r["bin_start"] for r in rows], edges[:-1])
    assert np.allclose([r["bin_end"] for r in rows], edges[1:])
    same = histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in same] == np.histogram([2.0, 2.0], bins=4)[0].tolist()
    assert (same[0]["bin_start"], same[-1]["bin_end"]) == (1.5, 2.5)


def test_quintile_edges_belong_to_the_lower_fifth(spark):
    shares = [0.0, 0.2, 0.2000001, 0.4, 0.6, 0.8, 1.0]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    assert [r[0] for r in df.select(labels.quintile(F.col("s"))).collect()] == [1, 1, 2, 2, 3, 4, 5]


def test_plain_words_join_what_punctuation_separated(spark):
    df = spark.createDataFrame([("Good.Bad food TASTES fine, it's the this ok cafés",)], "t string")
    assert df.select(text.plain_words(F.col("t"))).first()[0] == ["goodbad", "tastes", "fine", "cafs"]


def test_bare_words_keep_short_pieces_whole(spark):
    df = spark.createDataFrame([("(great!) :) a. don't  -x- end...",)], "t string")
    assert df.select(text.bare_words(F.col("t"))).first()[0] == ["great", ":)", "a.", "don't", "-x-", "end"]
