from datetime import datetime
from math import sqrt

import pytest
from pyspark.sql import functions as F

from basketwise.operators import sentiment
from basketwise.sources.lexicon import lexicon_tables


def _compound(total):
    return round(total / sqrt(total * total + 15), 4)


# sentence, sum of valences by the published rules (good 1.9, great 3.1, bad -2.5)
CASES = [
    ("it is good", 1.9),
    ("it is GOOD", 1.9 + 0.733),
    ("IT IS GOOD", 1.9),
    ("very good", 1.9 + 0.293),
    ("VERY good", 1.9 + 0.293 + 0.733),
    ("very much good", 1.9 + 0.293 * 0.95),
    ("very much so much good", 1.9 + 0.293 * 0.95),
    ("very it is good", 1.9 + 0.293 * 0.9),
    ("slightly bad", -2.5 + 0.293),
    ("very bad", -2.5 - 0.293),
    ("not good", 1.9 * -0.74),
    ("not very good", (1.9 + 0.293) * -0.74),
    ("isn't it good", 1.9 * -0.74),
    ("never so good", (1.9 + 0.293) * 1.25),
    ("least good", 1.9 * -0.74),
    ("at least good", 1.9),
    ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("good!", 1.9 + 0.292),
    ("good!!!!!!", 1.9 + 4 * 0.292),
    ("bad!!", -2.5 - 2 * 0.292),
    ("good?", 1.9),
    ("good??", 1.9 + 0.36),
    ("good?????", 1.9 + 0.96),
    ("great good", 3.1 + 1.9),
    ("nothing here!", 0.0),
    ("", 0.0),
    (None, 0.0),
]


def _scores(spark, texts, partitions=2):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "id long, t string").repartition(partitions)
    return sentiment.score_texts(docs, ["id"], {"t": "score"}, *lexicon_tables(spark))


@pytest.mark.parametrize("partitions", [1, 5])
def test_rules_on_sentences(spark, partitions):
    got = {r["id"]: r["score"] for r in _scores(spark, [t for t, _ in CASES], partitions).collect()}
    for i, (text, total) in enumerate(CASES):
        expected = _compound(total) if text != "nothing here!" else 0.0
        if text == "very much so much good":
            # 'so' is two words before, 'very' too far
            expected = _compound(1.9 + 0.293 * 0.95)
        assert got[i] == pytest.approx(expected, abs=1e-9), text


def test_long_text_is_read_to_its_end(spark):
    text = "word " * 20_000 + "good"
    assert _scores(spark, [text]).first()["score"] == _compound(1.9)


def test_null_keys_keep_their_scores(spark):
    docs = spark.createDataFrame([(None, "p", "good"), ("u", None, "bad")], "u string, p string, t string")
    rows = sentiment.score_texts(docs, ["u", "p"], {"t": "s"}, *lexicon_tables(spark)).collect()
    assert {r["t"]: r["s"] for r in rows} == {"good": _compound(1.9), "bad": _compound(-2.5)}


@pytest.fixture
def scored(spark):
    rows = [
        (i, f"u{i % 2}", "p" if i < 6 else "q", 5, "s", text, c, datetime(2020, 1 + i % 2, 5))
        for i, (text, c) in enumerate(
            [("Good.Bad taste", 0.5), ("taste taste", 0.05), ("taste", 0.0495), ("zebra", -0.05), ("x", 0.0),
             ("food taste", 0.9), ("aaaa", 0.8)]
        )
    ]
    df = spark.createDataFrame(
        rows,
        "ordinal long, UserId string, ProductId string, Rating int, Summary string, Text string, vader_compound double, "
        "ReviewDate timestamp",
    )
    return df.withColumns(
        {
            "vader_sentiment": sentiment.sentiment_class(F.col("vader_compound")),
            "YearMonth": F.date_format("ReviewDate", "yyyy-MM"),
        }
    )


def test_classes_include_their_edges(scored):
    labels = {r["Text"]: r["vader_sentiment"] for r in scored.collect()}
    assert (labels["taste taste"], labels["taste"], labels["zebra"]) == ("Positive", "Neutral", "Negative")


def test_products_are_rounded_before_the_threshold(scored):
    rows = sentiment.product_sentiment(scored, min_reviews=5).collect()
    assert [(r["ProductId"], r["review_count"], r["pct_positive"], r["pct_negative"]) for r in rows] == [
        ("p", 6, 50.0, 16.667)
    ]
    assert sentiment.product_sentiment(scored, min_reviews=1).count() == 2
    assert sentiment.best_products(sentiment.product_sentiment(scored, 1), 1).first()["ProductId"] == "q"


def test_months_and_their_unweighted_mean(scored):
    monthly = sentiment.monthly_sentiment(scored, min_reviews=3)
    means = {r["YearMonth"]: r["avg_sentiment"] for r in monthly.collect()}
    assert means == pytest.approx({"2020-01": 1.3495 / 4, "2020-02": 0.9 / 3})
    assert sentiment.monthly_sentiment_overall(monthly).first()[0] == pytest.approx(sum(means.values()) / 2)


def test_words_of_all_reviews_of_a_class(spark, scored):
    every = sentiment.word_frequencies(scored, "Positive").collect()
    assert [tuple(r) for r in every] == [("taste", 4), ("aaaa", 1), ("goodbad", 1)]
    many = spark.range(6000).selectExpr("'Positive' AS vader_sentiment", "concat('taste ', if(id > 5500, 'late', 'early')) AS Text")
    assert [tuple(r) for r in sentiment.word_frequencies(many, "Positive").collect()] == [("taste", 6000), ("early", 5501), ("late", 499)]
