"""Spelling variants of a corpus' words, from sorted permuterm rotations.

A word of L letters, marked with a terminator, has L + 1 rotations. A word that differs in one letter agrees with it on the
rotation that ends before that letter: the edited character comes last there and is skipped. So each word sends one row per
rotation with its last letter skipped, and one per whole rotation. After sorting, a range of equal rows holds the words
that differ in the skipped letter (replacements), and the at most one word that lacks it (insertions and deletions).
Such a range has no more words than the alphabet has letters, plus one, however large the corpus is.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwise.session import materialise

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: not in the alphabet of words, and before all its letters
_END = "$"
_DISTINCT = 200_000  # words counted by a task before it hands them on


def word_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", drop_every: int | None = None) -> DataFrame:
    """(word, n): the runs of Latin letters of every whole text with A-Z in lower case, and how often each occurs.

    Args:
        drop_every: if given, a run whose hash (crc32 of ``<doc_id>:<run>``) this number divides loses the letter at hash
            modulo length, which plants misspellings. A null id counts as an empty one. What is left may be empty.

    Null texts have no words; repeated rows count each; other columns are ignored. Tasks add up the words of many texts
    before the shuffle, so a very frequent word is a few rows per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(_RUN.findall(value or ""))
                if drop_every is None:
                    for word, n in found.items():
                        total[word.translate(_LOWER)] += n
                else:
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word, n in found.items():
                        word = word.lower() if word.isascii() else word.translate(_LOWER)
                        h = zlib.crc32(word.encode(), start)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        total[word] += n
                if len(total) >= _DISTINCT:
                    yield _counted(total)
                    total.clear()
        yield _counted(total)

    parts = docs.select(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])


def rotations(words: DataFrame) -> DataFrame:
    """(key, skipped, word, n): every rotation of the marked words, whole and with its last letter skipped.

    ``skipped`` is empty for whole rotations. A whole rotation only serves to find the word that has a letter more, and a
    letter that repeats the one before it gives the same shorter word: that row is marked ``again``.
    """
    size = F.length("word")
    each = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    tail, head = F.substring("word", F.col("i") + F.lit(1), size), F.substring("word", F.lit(1), F.col("i"))
    whole = F.concat(tail, F.lit(_END), head)
    # without letter i + 1: what follows it, the terminator, what precedes it
    short = F.concat(F.substring("word", F.col("i") + F.lit(2), size), F.lit(_END), head)
    letter = F.substring("word", F.col("i") + F.lit(1), F.lit(1))
    again = (F.col("i") > 0) & (letter == F.substring("word", F.col("i"), F.lit(1)))
    rows = F.array(
        F.struct(whole.alias("key"), F.lit("").alias("skipped"), F.lit(False).alias("again")),
        F.struct(short.alias("key"), letter.alias("skipped"), again.alias("again")),
    )
    opened = each.select("word", "n", F.inline(F.when(F.col("i") < size, rows).otherwise(F.slice(rows, 1, 1))))
    return opened.select("key", "skipped", "again", "word", "n")


def _pairs(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Both directions of every pair of neighbours within the ranges of equal keys of sorted rows."""
    key, skipped = rows.column("key"), rows.column("skipped")
    new = np.ones(rows.num_rows, dtype=bool)
    if rows.num_rows > 1:
        new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    group = np.cumsum(new)
    full = pc.equal(skipped, "").to_numpy(zero_copy_only=False)
    again = rows.column("again").to_numpy(zero_copy_only=False)
    lefts, rights = [], []
    step = 1
    while step < len(group):  # at most the size of the alphabet
        left = np.flatnonzero(group[step:] == group[:-step])
        if not len(left):
            break
        right = left + step
        # whole rotations sort first; beside one, only the first letter of a repeated run counts
        good = ~(full[left] & again[right])
        lefts.append(left[good])
        rights.append(right[good])
        step += 1
    left = np.concatenate(lefts) if lefts else np.zeros(0, np.int64)
    right = np.concatenate(rights) if rights else np.zeros(0, np.int64)
    a, b = pa.array(np.concatenate([left, right])), pa.array(np.concatenate([right, left]))
    word, n = rows.column("word"), rows.column("n")
    return pa.RecordBatch.from_arrays([word.take(a), word.take(b), n.take(b)], names=["word", "near", "near_n"])


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every other word at exactly one inserted, deleted or replaced letter, each pair in both directions.

    ``words``: distinct words with their ``n``; null and empty words have no neighbours. Nothing is capped: a word of L letters
    has at most (2 L + 1) times as many neighbours as the alphabet has letters.
    """
    rotated = rotations(words.where("word <> ''"))
    ordered = rotated.repartition("key").sortWithinPartitions("key", "skipped")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            last = pc.equal(batch.column("key"), batch.column("key")[-1]).to_numpy(zero_copy_only=False)
            edge = int(np.argmax(last))  # the last range may go on in the next batch
            if edge:
                yield _pairs(batch.slice(0, edge))
            rest = batch.slice(edge)
        if rest is not None:
            yield _pairs(rest)

    return ordered.mapInArrow(run, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words that have a form: pointers are doubled until every one ends at a word without form."""
    reach = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        reach = materialise(reach.join(further, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "spelling-roots")
        if reach.where("moved").isEmpty():
            return reach.select("word", "root")
        reach = reach.select("word", "root")


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    Args:
        words: distinct words with their ``n``.
        ratio: the form of a word is its most frequent neighbour (of equal ones the first in code-point order) if that is at least
            this many times as frequent; else null. Above 1, so that following forms ends.

    ``root`` is where following forms ends, the word itself if it has none. ``n_near`` counts the neighbours.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    words = materialise(words, "spelling-words")
    # Spark compares strings by their UTF-8 bytes, which is code-point order
    first = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    near = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    named = words.join(near, "word", "left")
    found = -F.col("best.n") >= F.col("n") * ratio
    formed = materialise(
        named.select(
            "word",
            F.when(found, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(found, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
