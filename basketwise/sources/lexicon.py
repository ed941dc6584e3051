"""Word tables for sentiment scoring. Any tables with the same columns can be used instead."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Degree words and their weights.
MORE = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply enormous enormously "
    "entirely especially exceptional exceptionally extreme extremely fabulously fully greatly highly hugely "
    "incredible incredibly intensely major majorly more most particularly purely quite really remarkably so "
    "substantially thoroughly total totally tremendous tremendously unbelievably unusually utter utterly very"
).split()
LESS = (
    "almost barely hardly less little marginal marginally occasional occasionally partly scarce scarcely slight "
    "slightly somewhat"
).split()
MORE_WEIGHT = 0.293
LESS_WEIGHT = -0.293

# Words that turn the meaning round.
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neednt "
    "neither never no nobody none nope nor not nothing nowhere oughtnt shant shouldnt wasnt werent without wont "
    "wouldnt rarely seldom despite"
).split()

# A small lexicon, word and valence from -4 to 4. Many valences, and the degree and negation words above,
# agree with the public VADER list (Hutto and Gilbert 2014, MIT licence) and are to be taken as coming from it; offline they
# could not be compared.
WORDS = {
    "amazing": 2.8, "awesome": 3.1, "awful": -2.0, "bad": -2.5, "best": 3.2, "better": 1.9, "bland": -1.1,
    "broken": -1.9, "delicious": 2.7, "delightful": 2.8, "disappointed": -2.1, "disappointing": -2.2,
    "disgusting": -2.4, "dislike": -1.6, "enjoy": 2.2, "enjoyed": 2.3, "excellent": 2.7, "fantastic": 2.6,
    "fine": 0.8, "fresh": 1.3, "good": 1.9, "great": 3.1, "happy": 2.7, "hate": -2.7, "horrible": -2.5,
    "idiot": -2.3, "love": 3.2, "loved": 2.9, "lovely": 2.8, "nasty": -2.6, "nice": 1.8, "perfect": 2.7,
    "pleased": 1.9, "poor": -2.1, "recommend": 1.5, "sad": -2.1, "stale": -1.2, "stupid": -2.4, "superb": 3.1,
    "tasty": 1.9, "terrible": -2.1, "waste": -1.8, "wonderful": 2.7, "worst": -3.1, "worthless": -1.9,
    "wrong": -2.1, "yummy": 2.4,
}

# The test prose is made of invented words; these values give it something to score.
FIXTURE_WORDS = {
    "that": 1.6, "with": -1.2, "from": -1.7, "rewh": 2.1, "orre": -2.4, "ononst": 1.3, "hehely": -0.9,
    "was": -0.7, "les": 1.1, "des": -1.3, "und": 1.4, "die": -1.0, "que": 0.9, "th": 0.8, "re": -0.6,
}
FIXTURE_BOOSTERS = {"is": 0.293, "it": 0.293, "de": 0.293, "der": 0.293, "for": -0.293, "la": -0.293}
FIXTURE_NEGATIONS = ["on", "be", "en"]


def _two_columns(spark: SparkSession, values: dict[str, float], name: str) -> DataFrame:
    return spark.createDataFrame(
        pa.table({"token": pa.array(values.keys(), pa.string()), name: pa.array(values.values(), pa.float64())})
    )


def default_boosters() -> dict[str, float]:
    return {**dict.fromkeys(MORE, MORE_WEIGHT), **dict.fromkeys(LESS, LESS_WEIGHT)}


def lexicon_tables(
    spark: SparkSession,
    words: dict[str, float] | None = None,
    boosters: dict[str, float] | None = None,
    negations: list[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lexicon, boosters, negations) as tables; the defaults are the lists above."""
    return (
        _two_columns(spark, WORDS if words is None else words, "valence"),
        _two_columns(spark, default_boosters() if boosters is None else boosters, "weight"),
        spark.createDataFrame(
            pa.table({"token": pa.array(NEGATIONS if negations is None else negations, pa.string())})
        ),
    )


def fixture_lists() -> tuple[dict[str, float], dict[str, float], list[str]]:
    return (
        {**WORDS, **FIXTURE_WORDS},
        {**default_boosters(), **FIXTURE_BOOSTERS},
        NEGATIONS + FIXTURE_NEGATIONS,
    )
