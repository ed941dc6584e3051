"""Lexicon sentiment and the summaries built on it.

Rules and constants follow Hutto and Gilbert, "VADER: A Parsimonious Rule-based Model for Sentiment
Analysis of Social Media Text" (ICWSM 2014); the words come from input tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwise.functions.labels import sentiment_class
from basketwise.functions.numeric import exact_mean, percent_where, round_even
from basketwise.functions.text import bare_words, count_char, is_upper, plain_words

# Fixed values of the published rules.
NORMALISATION = 15.0
CAPITALS = 0.733
NEGATED = -0.74
NEVER_SO = 1.25
DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MANY_QUESTIONS = 0.18, 0.96

# Valences are added up as whole billionths, so that their order does not matter.
UNIT = 1e9


def _emphasis(text: Column) -> Column:
    marks = F.least(count_char(text, "!"), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION
    asked = count_char(text, "?")
    doubts = F.when(asked <= 1, 0.0).when(asked <= 3, asked * QUESTION).otherwise(MANY_QUESTIONS)
    return marks + doubts


def _modifiers(lexicon: DataFrame, boosters: DataFrame, negations: DataFrame) -> DataFrame:
    """One row per word with its valence, its weight as a degree word, and whether it negates."""
    nothing = F.lit(None).cast("double")
    return (
        lexicon.select("token", "valence", nothing.alias("weight"), F.lit(False).alias("negates"))
        .unionByName(boosters.select("token", nothing.alias("valence"), "weight", F.lit(False).alias("negates")))
        .unionByName(negations.select("token", nothing.alias("valence"), nothing.alias("weight"), F.lit(True).alias("negates")))
        .groupBy("token")
        .agg(F.max("valence").alias("valence"), F.max("weight").alias("weight"), F.max("negates").alias("negates"))
    )


def _occurrences(docs: DataFrame, keys: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Every word of every text with the three words before it and the marks of its text."""
    fields = F.array(*[F.struct(F.lit(t).alias("field"), F.col(t).alias("text")) for t in texts])
    one_text = docs.select(*keys, F.explode(fields).alias("f")).select(*keys, "f.field", "f.text")
    split = one_text.withColumn("w", bare_words(F.col("text"))).withColumn("emphasis", _emphasis(F.col("text")))
    loud = F.size(F.filter("w", is_upper))
    blank = F.lit(None).cast("string")
    marked = split.select(
        *keys,
        "field",
        "emphasis",
        ((loud > 0) & (loud < F.size("w"))).alias("mixed"),
        F.array_position(F.transform("w", F.lower), "but").alias("but_at"),
        F.arrays_zip(
            F.col("w").alias("w0"),
            F.concat(F.array(blank), "w").alias("w1"),
            F.concat(F.array(blank, blank), "w").alias("w2"),
            F.concat(F.array(blank, blank, blank), "w").alias("w3"),
        ).alias("z"),
    )
    return (
        # the outer form: for the inner one Spark would split every text once more to filter out empty ones
        marked.select(*keys, "field", "emphasis", "mixed", "but_at", F.posexplode_outer("z").alias("at", "z"))
        .select(*keys, "field", "emphasis", "mixed", "but_at", "at", "z.*")
        .where("w0 IS NOT NULL")
    )


def _valence(words: DataFrame) -> DataFrame:
    """Valence of each lexicon word after emphasis by capitals, degree words, negation and 'but'."""
    v = F.col("v")
    low = {j: F.lower(f"w{j}") for j in (1, 2, 3)}
    in_so = {j: low[j].isin("so", "this") for j in (1, 2)}
    out = words.withColumn(
        "v", F.col("valence") + F.when(is_upper(F.col("w0")) & F.col("mixed"), F.signum("valence") * CAPITALS).otherwise(0.0)
    )
    for j in (1, 2, 3):
        free = F.col(f"w{j}").isNotNull() & F.col(f"valence{j}").isNull()
        louder = F.when(is_upper(F.col(f"w{j}")) & F.col("mixed"), CAPITALS).otherwise(0.0)
        toward = F.when(v < 0, -F.col(f"weight{j}")).otherwise(F.col(f"weight{j}"))
        push = toward + F.when(v > 0, louder).otherwise(-louder)
        out = out.withColumn("v", v + F.when(free, F.coalesce(push, F.lit(0.0)) * DAMPING[j]).otherwise(0.0))
        turn = F.when(F.coalesce(f"negates{j}", F.lit(False)) | low[j].contains("n't"), NEGATED).otherwise(1.0)
        if j == 2:
            turn = (
                F.when((low[2] == "never") & in_so[1], NEVER_SO)
                .when((low[2] == "without") & (low[1] == "doubt"), 1.0)
                .otherwise(turn)
            )
        if j == 3:
            turn = (
                F.when((low[3] == "never") & (in_so[2] | in_so[1]), NEVER_SO)
                .when((low[3] == "without") & ((low[2] == "doubt") | (low[1] == "doubt")), 1.0)
                .otherwise(turn)
            )
        out = out.withColumn("v", v * F.when(free, turn).otherwise(1.0))
    least = (
        (low[1] == "least") & F.col("valence1").isNull() & ~F.coalesce(low[2].isin("at", "very"), F.lit(False))
    )
    but = F.col("but_at")
    place = F.col("at") + 1
    clause = (
        F.when((but > 0) & (place < but), BEFORE_BUT).when((but > 0) & (place > but), AFTER_BUT).otherwise(1.0)
    )
    return out.withColumn("v", v * F.when(least, NEGATED).otherwise(1.0)).withColumn("v", v * clause)


def _compound(total: Column, emphasis: Column) -> Column:
    pushed = F.when(total > 0, total + emphasis).when(total < 0, total - emphasis).otherwise(0.0)
    return round_even(pushed / F.sqrt(pushed * pushed + NORMALISATION), 4)


def score_texts(
    docs: DataFrame,
    keys: Sequence[str],
    texts: dict[str, str],
    lexicon: DataFrame,
    boosters: DataFrame,
    negations: DataFrame,
) -> DataFrame:
    """Add a compound score in [-1, 1] for each of some text columns.

    ``keys`` name the columns that identify a row; they may be null. ``texts`` maps text column to score
    column. Words outside the lexicon are dropped at the first join, before anything is shuffled; the
    word tables are small, and Spark broadcasts them as far as their size allows.
    """
    modifiers = _modifiers(lexicon, boosters, negations)
    scored = modifiers.where("valence IS NOT NULL AND weight IS NULL").select(F.col("token").alias("t0"), "valence")
    words = _occurrences(docs, keys, list(texts)).join(scored, F.lower("w0") == F.col("t0")).drop("t0")
    for j in (1, 2, 3):
        before = modifiers.toDF(f"t{j}", f"valence{j}", f"weight{j}", f"negates{j}")
        words = words.join(before, F.lower(f"w{j}") == F.col(f"t{j}"), "left").drop(f"t{j}")
    rated = _valence(words).select(*keys, "field", "emphasis", F.rint(F.col("v") * UNIT).cast("long").alias("points"))
    totals = rated.groupBy(*keys).agg(
        *[
            _compound(
                F.sum(F.when(F.col("field") == text, F.col("points"))) / UNIT,
                F.max(F.when(F.col("field") == text, F.col("emphasis"))),
            ).alias(score)
            for text, score in texts.items()
        ]
    )
    totals = totals.select(*[F.col(c).alias(f"_k_{c}") for c in keys], *texts.values())
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    joined = docs.join(totals, same, "left")
    return joined.select(*docs.columns, *[F.coalesce(s, F.lit(0.0)).alias(s) for s in texts.values()])


def reviews_with_sentiment(
    reviews: DataFrame,
    lexicon: DataFrame,
    boosters: DataFrame,
    negations: DataFrame,
    keys: Sequence[str] = ("UserId", "ProductId"),
) -> DataFrame:
    """Reviews with a score for text and summary, the class of the text, and the month; ``keys`` identify a review."""
    texts = {"Text": "vader_compound", "Summary": "summary_sentiment"}
    return score_texts(reviews, keys, texts, lexicon, boosters, negations).withColumns(
        {
            "vader_sentiment": sentiment_class(F.col("vader_compound")),
            "YearMonth": F.date_format("ReviewDate", "yyyy-MM"),
        }
    )


def _class_pct(label: str) -> Column:
    return percent_where(F.col("vader_sentiment") == label)


_MEAN = exact_mean
_SCORE = "vader_compound"


def sentiment_stats(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        F.count(F.lit(1)).alias("reviews"),
        _MEAN(F.col(_SCORE)).alias("avg_compound"),
        F.min(_SCORE).alias("min_compound"),
        F.max(_SCORE).alias("max_compound"),
        *[_class_pct(label).alias(f"pct_{label.lower()}") for label in ("Positive", "Neutral", "Negative")],
    )


def sentiment_by_rating(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("Rating").isNotNull())
        .groupBy("Rating")
        .agg(
            round_even(_MEAN(F.col(_SCORE)), 3).alias("avg_vader"),
            F.count(_SCORE).alias("count"),
            round_even(_class_pct("Positive"), 3).alias("pct_positive"),
        )
        .orderBy("Rating")
    )


def product_sentiment(reviews: DataFrame, min_reviews: int = 5) -> DataFrame:
    """Sentiment per product, rounded to 3 digits, for products with enough reviews."""
    return (
        reviews.where(F.col("ProductId").isNotNull())
        .groupBy("ProductId")
        .agg(
            round_even(_MEAN(F.col(_SCORE)), 3).alias("avg_sentiment"),
            F.count(_SCORE).alias("review_count"),
            round_even(_MEAN(F.col("Rating")), 3).alias("avg_rating"),
            round_even(_class_pct("Positive"), 3).alias("pct_positive"),
            round_even(_class_pct("Negative"), 3).alias("pct_negative"),
        )
        .where(F.col("review_count") >= min_reviews)
    )


def best_products(products: DataFrame, n: int = 10) -> DataFrame:
    return products.orderBy(F.desc("avg_sentiment"), "ProductId").limit(n)


def worst_products(products: DataFrame, n: int = 10) -> DataFrame:
    return products.orderBy("avg_sentiment", "ProductId").limit(n)


def monthly_sentiment(reviews: DataFrame, min_reviews: int = 50) -> DataFrame:
    return (
        reviews.groupBy("YearMonth")
        .agg(
            _MEAN(F.col(_SCORE)).alias("avg_sentiment"),
            F.count(_SCORE).alias("review_count"),
            _class_pct("Positive").alias("pct_positive"),
        )
        .where(F.col("YearMonth").isNotNull() & (F.col("review_count") >= min_reviews))
    )


def monthly_sentiment_overall(monthly: DataFrame) -> DataFrame:
    """Unweighted means over the months kept."""
    return monthly.agg(
        exact_mean(F.col("avg_sentiment"), 9).alias("avg_sentiment"),
        exact_mean(F.col("pct_positive"), 9).alias("pct_positive"),
    )


def user_sentiment(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("UserId").isNotNull())
        .groupBy("UserId")
        .agg(
            _MEAN(F.col(_SCORE)).alias("avg_sentiment"),
            F.count(_SCORE).alias("review_count"),
            _class_pct("Positive").alias("pct_positive"),
        )
    )


def word_frequencies(reviews: DataFrame, label: str, n: int = 30) -> DataFrame:
    """Most frequent words in all reviews of one class."""
    return (
        reviews.where(F.col("vader_sentiment") == label)
        .select(F.explode(plain_words(F.col("Text"))).alias("word"))
        .groupBy("word")
        .count()
        .orderBy(F.desc("count"), "word")
        .limit(n)
    )
