"""Removal of repeated word windows by seed and extend.

1. Seeds: of every window's word grams the one with the smallest hash is its anchor (winnowing), so equal windows have equal
   anchors. Anchors of all texts are joined on their value.
2. Extension: where an anchor occurs in several places, every window around it (the anchor extended to the left and
   right up to the window's length) is hashed and joined with those of the other places. A passage of n texts takes n steps,
   not one per pair of them.
3. Windows that meet another one are united to maximal repeats, whose words are removed.

Texts are told apart by a 64-bit hash. Equal texts are processed as one; a text with a copy is repeated as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwise.llm import seeds
from basketwise.llm.arrow import gram_hashes, sliding_min, text_chunks, word_hashes, words
from basketwise.session import materialise

_ENTRY = np.dtype([("value", "<u8"), ("sid", "<i8"), ("pos", "<u4")])


def _hashed(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """First word of each text, gram hashes, window anchors and word hashes of a chunk."""
    starts, ends, first = words(data, offsets)
    each = word_hashes(data, starts, ends, lower=False)
    grams = gram_hashes(each, gram)
    width = window - gram + 1
    anchors = sliding_min(grams, width) if len(grams) >= width else np.zeros(0, np.uint64)
    return first, grams, anchors, each


def _sorted_entries(sids: list[int], counts: list[int], values: list[np.ndarray], places: list[np.ndarray]) -> np.ndarray:
    entries = np.empty(sum(counts), _ENTRY)
    entries["sid"] = np.repeat(np.array(sids, np.int64), counts)
    entries["value"] = np.concatenate(values)
    entries["pos"] = np.concatenate(places)
    return entries[np.argsort(entries["value"], kind="stable")]


def _repeated(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries sorted by value: which are not alone, and which are the first of their value."""
    same = entries["value"][1:] == entries["value"][:-1]
    more = np.zeros(len(entries), bool)
    more[1:] |= same
    more[:-1] |= same
    first = np.ones(len(entries), bool)
    first[1:] = ~same
    return more, first


def _send(entries: np.ndarray, sure: np.ndarray, first: np.ndarray, buckets: int, known: str) -> pa.RecordBatch:
    """What is settled in the chunk, and one entry of each value for the others."""
    parts: list[tuple[int, int | None, bytes]] = []
    kept = entries[first]
    for bucket, run in seeds.dealt(kept, (kept["value"] % np.uint64(buckets)).astype(np.int64)):
        parts.append((bucket, None, run.tobytes()))
    for sid, data in seeds.by_text(entries["sid"][sure], entries[known][sure]):
        parts.append((sid % buckets, sid, data))
    return seeds.rows(parts)


def _settle(known: str):
    def settle(_: int, runs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        entries = np.frombuffer(b"".join(runs), _ENTRY)
        entries = np.unique(entries)  # an equal text in another task
        more, _ = _repeated(entries)
        yield from seeds.by_text(entries["sid"][more], entries[known][more])

    return settle


def _anchors(texts: DataFrame, window: int, gram: int, buckets: int) -> DataFrame:
    """(sid, anchors) that occur in several places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column(0).to_pylist()
            for low, _, data, offsets in text_chunks(batch.column(1)):
                first, grams, anchors, _ = _hashed(data, offsets, window, gram)
                own: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                for r, (a, b) in enumerate(zip(first, first[1:])):
                    if b - a >= window and sids[low + r] not in own:
                        value, count = np.unique(grams[a : b - gram + 1], return_counts=True)
                        picked = np.unique(anchors[a : b - window + 1])
                        own[sids[low + r]] = picked, count[np.searchsorted(value, picked)] > 1
                if not own:
                    continue
                picked, again = zip(*own.values())
                entries = _sorted_entries(list(own), [len(p) for p in picked], list(picked), [x.astype(np.uint32) for x in again])
                more, first_of = _repeated(entries)
                sure = more | (entries["pos"] > 0)  # in two texts of the chunk, or twice in one
                entries["pos"] = 0
                yield _send(entries, sure, first_of, buckets, "value")

    return seeds.exchange(texts.mapInArrow(run, seeds.ROWS), buckets, _settle("value"))


def _windows(marked: DataFrame, window: int, gram: int, buckets: int) -> DataFrame:
    """(sid, places) of the windows that occur elsewhere; ``marked``: (sid, text, data with the repeated anchors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, marks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for low, _, data, offsets in text_chunks(batch.column(1)):
                first, _, anchors, each = _hashed(data, offsets, window, gram)
                hashes = gram_hashes(each, window)
                own: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                for r, (a, b) in enumerate(zip(first, first[1:])):
                    if b - a >= window and sids[low + r] not in own:
                        known = np.sort(seeds.unpacked(marks[low + r], "<u8"))
                        mine = anchors[a : b - window + 1]
                        place = np.flatnonzero(known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine)
                        own[sids[low + r]] = hashes[a + place], place.astype(np.uint32)
                if not own:
                    continue
                values, places = zip(*own.values())
                entries = _sorted_entries(list(own), [len(v) for v in values], list(values), list(places))
                more, first_of = _repeated(entries)
                yield _send(entries, more, first_of, buckets, "pos")

    return seeds.exchange(marked.mapInArrow(run, seeds.ROWS), buckets, _settle("pos"))


def remove_repeats(docs: DataFrame, *, window: int = 35, gram: int = 16, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``: the words that no repeated window covers, joined by one space.

    Words are runs of other than ASCII white space, unchanged. A window is ``window`` consecutive words of one text; it is
    repeated if its words also start anywhere else, in the same text too. All its places are removed, the first as well.
    A null or empty text has no words and keeps none. Columns of ``docs`` with the three names are replaced; all rows stay.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("n_words", "n_removed", "kept")]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.xxhash64(whole).alias("sid"), whole.alias("text"))
    spark = docs.sparkSession
    sizes = texts.groupBy("sid").agg(F.count(F.lit(1)).alias("copies"), F.first(F.octet_length("text")).alias("size"))
    sizes = materialise(sizes, "repeat-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total) // (64 << 20) + 1)

    anchors = seeds.collected(materialise(_anchors(texts, window, gram, buckets), "repeat-anchors"), buckets)
    marked = texts.join(anchors, "sid").select("sid", "text", "data")
    places = seeds.collected(materialise(_windows(marked, window, gram, buckets), "repeat-places"), buckets)
    facts = sizes.where("copies > 1").select("sid", "copies").join(places, "sid", "full").withColumnRenamed("data", "__places")
    facts = materialise(facts, "repeat-facts")

    out = T.StructType([*kept, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    at = [f.name for f in kept].index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, spans = batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()
            found: list[list] = [[], [], []]
            for low, high, data, offsets in text_chunks(batch.column(at)):
                for r in range(high - low):
                    parts = data[offsets[r] : offsets[r + 1]].tobytes().split()
                    n = len(parts)
                    gone = 0
                    if n >= window and copies[low + r]:
                        parts, gone = [], n
                    elif n >= window and spans[low + r]:
                        begin = seeds.unpacked(spans[low + r], "<u4").astype(np.int64)
                        cover = np.bincount(begin, minlength=n + 1) - np.bincount(begin + window, minlength=n + 1)
                        stays = np.cumsum(cover)[:n] == 0
                        parts, gone = list(compress(parts, stays)), int(n - stays.sum())
                    for column, value in zip(found, (n, gone, b" ".join(parts).decode("utf-8", "replace"))):
                        column.append(value)
            arrays = [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *arrays], names=out.names)

    named = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.xxhash64(whole).alias("__sid"))
    joined = named.join(facts.withColumnRenamed("sid", "__sid"), "__sid", "left")
    return joined.select(*[f"`{f.name}`" for f in kept], "copies", "__places").mapInArrow(cut, out)
