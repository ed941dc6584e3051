"""Word splitting for sentiment scoring and word counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words left out of the word counts.
STOPWORDS = (
    "the a an and or but in on at to for of with is it this that was are be as have has had i my we you your "
    "they their not no so just very also one use used product food item order buy bought get got"
).split()

# Fixed value: ASCII punctuation, as character ranges.
PUNCTUATION = r"!-/:-@\[-`{-~"

SPACES = r"(?U)\s+"


def words(text: Column) -> Column:
    """Split on Unicode white space, keeping case and dropping empty pieces."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def bare_words(text: Column) -> Column:
    """Words without leading and trailing punctuation; what would get shorter than 3 stays whole."""
    edge = f"^[{PUNCTUATION}]+|[{PUNCTUATION}]+$"

    def bare(word: Column) -> Column:
        return F.regexp_replace(word, edge, "")

    return F.transform(words(text), lambda w: F.when(F.length(bare(w)) <= 2, w).otherwise(bare(w)))


def is_upper(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def plain_words(text: Column) -> Column:
    """Lower-cased a-z words longer than three letters that are not stopwords."""
    letters = F.regexp_replace(F.lower(text), r"(?U)[^a-z\s]", "")
    return F.filter(words(letters), lambda w: (F.length(w) > 3) & ~w.isin(STOPWORDS))


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))
