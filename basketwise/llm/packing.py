"""Documents packed into training sequences of one length: a cutting-stock problem solved by column generation.

Documents longer than a sequence are cut at its length; what is left of each is one piece. Pieces are counted by length class,
each class as long as its longest possible piece. A linear program chooses how often each pattern (so many pieces of these
classes) is cut from a sequence; a knapsack by dynamic programming finds the pattern that its prices favour most, until none
would help. The classes are few, so the program's size does not depend on the number of documents. Patterns rounded
down take the pieces of a class by rank; the few that remain, a bounded number, are filled up greedily, and what does not fill a
sequence well is strung together and cut.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from basketwise.session import materialise

#: a piece of text between these has the same ids wherever it stands: the vocabulary's normaliser and pattern do not cross them
_GAP = re.compile(r"[\x20\x09-\x0D]+")
#: what str.split takes for a gap beyond the ASCII white space
_OTHER = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")
#: Latin-1 characters: composing changes none of them, and lower case goes letter by letter
_LATIN = bytes(range(256)).decode("latin-1")
_LOWER = np.frombuffer(_LATIN.lower().encode("latin-1"), np.uint8)
_GAPS, _WORD, _DIGIT, _REST = range(4)
#: fixed values: the classes of the vocabulary's pre-token pattern, for these characters in lower case
_CLASSES = (r"[\x09-\x0d\x20\x85\xa0]", "[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]", "[0-9\xb2\xb3\xb9\xbc-\xbe]", r"[\x00-\xff]")
_KIND = np.array([next(k for k, p in enumerate(_CLASSES) if re.fullmatch(p, c)) for c in _LATIN], np.uint8)
#: the character that stands for each byte in a byte-level vocabulary: printable ones as they are, the others from 256 on; spaces stay
_LETTERS = np.arange(256, dtype="<u2")
_UNSEEN = np.setdiff1d(_LETTERS, [*range(33, 127), *range(161, 173), *range(174, 256)])
_LETTERS[_UNSEEN] = 256 + np.arange(len(_UNSEEN))
_LETTERS[32] = 32
_KEPT = 300_000  # pieces remembered by a worker, in each of two generations
_LONG = 64
_LOOSE = 1 / 64  # a greedily filled sequence with more than this part free is cut anew


class _Memory(dict):
    """Remembers the latest values, in two generations."""

    def __init__(self) -> None:
        super().__init__()
        self.old: dict = {}

    def lookup(self, keys: list, make) -> list[bytes]:
        """The value of every key; ``make`` gives those of unknown ones, in order."""
        out = list(map(self.get, keys))
        if None in out:
            new = dict.fromkeys(k for k, v in zip(keys, out) if v is None)
            old = self.old
            fresh = [k for k in new if k not in old]
            found = {k: old[k] for k in new if k in old}
            found.update(zip(fresh, make(fresh)))
            out = [found[k] if v is None else v for k, v in zip(keys, out)]
            if len(self) >= _KEPT:
                self.old = dict(self)
                self.clear()
            self.update((k, v) for k, v in found.items() if len(k) <= _LONG)
        return out


def _latin(text: str) -> bytes | None:
    """The text in Latin-1, if it has no other characters and nothing that may be a special token."""
    try:
        return None if "<|" in text else text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def _pre_tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the pre-tokens in Latin-1 text of lower case: runs of one class, digits singly, and 's, 't, 're, 've, 'm, 'll, 'd."""
    kind = _KIND[data]
    begins = np.ones(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    start = np.flatnonzero(begins)
    solid = kind[start] != _GAPS
    end = np.append(start[1:], len(data))
    quote = np.flatnonzero((data[start] == ord("'")) & (end - start == 1) & (end < len(data)))
    after = np.append(data, np.uint8(0))
    first, second = after[end[quote]], after[end[quote] + 1]
    two = (np.isin(first, list(b"rv")) & (second == ord("e"))) | ((first == ord("l")) & (second == ord("l")))
    taken = np.isin(first, list(b"stmd")) + 2 * two
    end[quote] += taken
    start[quote + 1] += taken
    solid &= start < end
    return start[solid], end[solid]


class _Words:
    """Ids of texts by the tokenizers library, as bytes of little-endian 32-bit integers.

    The library encodes a text's pre-tokens one by one, and these repeat. So texts come many at a time, their distinct pre-tokens are
    looked up once, and the library sees the unknown ones together: the last id of a pre-token is one of a word's end. Pre-tokens found
    here are lower case, composed and written in the vocabulary's characters for bytes already, so the library needs to cut them at
    spaces only. Texts with other than Latin-1 characters, or with what may be a special token, are cut at white space only.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer, self.cutter = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for tokenizer in (self.tokenizer, self.cutter):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        self.cutter.normalizer = normalizers.Sequence([])
        self.cutter.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.parts, self.whole = _Memory(), _Memory()

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        plain = [_latin(text) for text in texts]
        simple = [x for x in plain if x is not None]
        data = _LOWER[np.frombuffer(b"\n".join([*simple, b"\n"]), np.uint8)]
        start, end = _pre_tokens(data)
        edges = np.searchsorted(start, np.cumsum([0, *[len(x) + 1 for x in simple]]))
        offsets = np.append(0, np.cumsum(end - start)).astype(np.int32)
        solid = pa.py_buffer(data[_KIND[data] != _GAPS])
        coded = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), solid]).dictionary_encode()
        known = self.parts.lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self._together)
        ids, size = np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4
        first, which = np.cumsum(size) - size, coded.indices.to_numpy()
        spans = zip(edges.tolist(), edges[1:].tolist())
        for text, latin in zip(texts, plain):
            if latin is None:
                words = _GAP.split(text) if _OTHER.search(text) else text.split()
                yield b"".join(self.whole.lookup(words, self._separately))
            else:
                a, b = next(spans)
                n = size[which[a:b]]
                at = np.repeat(first[which[a:b]] - (np.cumsum(n) - n), n)
                at += np.arange(len(at))
                yield ids[at].tobytes()

    def _separately(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, parts: list[bytes]) -> list[bytes]:
        utf8 = b" ".join(parts).decode("latin-1").encode()
        letters = _LETTERS[np.frombuffer(utf8, np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.cutter.encode_batch_fast([letters], add_special_tokens=False)[0].ids, dtype="<u4")
        edges = np.flatnonzero(self.ends[ids]) + 1 if len(ids) else np.zeros(0, np.int64)
        if len(edges) != len(parts) or (len(parts) and edges[-1] != len(ids)):
            return self._separately([x.decode("latin-1") for x in parts])
        data, at = ids.tobytes(), (4 * np.append(0, edges)).tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]


_OPEN: dict[str, _Words] = {}


def _words(path: str) -> _Words:
    if path not in _OPEN:
        _OPEN[path] = _Words(path)
    return _OPEN[path]


def cut_documents(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, keep: list[str], text: str = "text") -> DataFrame:
    """One row per piece of a document: ``keep``, text_key, start, length, ids_crc32, doc_tokens.

    Ids are those of the tokenizers library without special tokens, then ``end_id``; ids do not leave the task. ``text_key`` is a hash
    by which the text is found again. A null text counts as an empty one, which has the end id alone.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.xxhash64(whole, F.octet_length(whole)).alias("text_key"), whole.alias("__text"))
    added = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType())]
    schema = T.StructType([f for f in source.schema.fields if f.name != "__text"] + [T.StructField(n, t) for n, t in added])
    last = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _words(vocabulary)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for i, ids in enumerate(coder.encode_all(batch.column("__text").to_pylist())):
                ids += last
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = memoryview(ids)[4 * start : 4 * (start + capacity)]
                    rows.append((i, start, len(part) // 4, zlib.crc32(part), total))
            if rows:
                at, *values = (pa.array(c, pa.int64()) for c in zip(*rows))
                carried = [batch.column(f.name).take(at) for f in schema.fields[: -len(added)]]
                yield pa.RecordBatch.from_arrays([*carried, *values], names=schema.names)

    return source.mapInArrow(run, schema)


# ---------------------------------------------------------------- the linear program


def _knapsack(prices: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern of at most ``units`` units; class s (from 1) takes s units."""
    sizes = np.arange(1, units + 1)
    best, chosen = np.zeros(units + 1), np.zeros(units + 1, dtype=np.int64)
    for room in range(1, units + 1):
        value = best[room - sizes[:room]] + prices[:room]
        at = int(np.argmax(value))
        if value[at] > best[room - 1] + 1e-12:
            best[room], chosen[room] = value[at], at + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(units), units
    while room > 0:
        if chosen[room]:
            pattern[chosen[room] - 1] += 1
            room -= chosen[room]
        else:
            room -= 1
    return float(best[units]), pattern


def column_generation(demand: np.ndarray, units: int, gap: float = 1e-3) -> list[tuple[float, np.ndarray]]:
    """(how often, pattern) of a linear program that covers the demand of every class with the fewest sequences.

    Args:
        demand: how many pieces each class has; a piece of class s (from 1) takes s of the ``units`` of a sequence.
        gap: stop when the number of sequences is proved to be within this part of the least.

    The patterns in the basis are as many as classes in demand at most.
    """
    used = np.flatnonzero(demand > 0)
    if not len(used):
        return []
    m = len(used)
    sizes = used + 1
    patterns = np.diag((units // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(patterns))
    amount = inverse @ demand[used]
    for step in range(20 * m + 1000):
        prices = np.zeros(units)
        prices[used] = np.maximum(inverse.sum(axis=0), 0.0)
        value, pattern = _knapsack(prices, units)
        if value <= 1 + gap or value <= 1 + 1e-9:  # total / value is a lower bound of the least total
            break
        column = pattern[used]
        direction = inverse @ column
        rising = direction > 1e-9
        if not rising.any():
            break
        ratio = np.full(m, np.inf)
        ratio[rising] = amount[rising] / direction[rising]
        out = int(np.argmin(ratio))
        by = ratio[out]
        amount -= by * direction
        amount[out] = by
        amount = np.maximum(amount, 0.0)
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        patterns[:, out] = column
        if step % 500 == 499:  # rounding errors do not add up
            inverse = np.linalg.inv(patterns)
            amount = np.maximum(inverse @ demand[used], 0.0)
    out = []
    for k in range(m):
        pattern = np.zeros(units, dtype=np.int64)
        pattern[used] = np.rint(patterns[:, k]).astype(np.int64)
        out.append((float(amount[k]), pattern))
    return out


@dataclass
class Plan:
    """Which ranks of a class go to which sequences: rows (class, first rank, end rank, pieces per sequence, first sequence)."""

    slots: list[tuple[int, int, int, int, int]]
    sequences: int
    loose: dict[int, int]  # the first rank of a class that has no sequence


def plan_sequences(demand: np.ndarray, units: int) -> Plan:
    """Whole numbers of patterns for the demand, as slots for ranks.

    The program's amounts are rounded down; what remains (less than one pattern per class) is filled greedily, largest class
    first, and sequences that this leaves with more than 1/64 free are given up: their pieces are loose.
    """
    left = demand.astype(np.int64).copy()
    chosen: list[tuple[int, np.ndarray]] = []
    for amount, pattern in column_generation(demand.astype(float), units):
        fits = [int(left[c] // pattern[c]) for c in np.flatnonzero(pattern)]
        times = min([int(amount + 1e-6), *fits])
        if times > 0:
            chosen.append((times, pattern))
            left -= times * pattern
    while left.any():
        room, pattern = units, np.zeros(units, dtype=np.int64)
        for c in np.flatnonzero(left)[::-1]:
            take = min(int(left[c]), room // (int(c) + 1))
            pattern[c] += take
            room -= take * (int(c) + 1)
        if room > units * _LOOSE:
            break  # later ones are no fuller: larger classes come first
        have = pattern > 0
        times = int((left[have] // pattern[have]).min())
        chosen.append((times, pattern))
        left -= times * pattern
    slots, at, sequence = [], np.zeros(units, dtype=np.int64), 0
    for times, pattern in chosen:
        for c in np.flatnonzero(pattern):
            many = int(pattern[c])
            slots.append((int(c) + 1, int(at[c]), int(at[c]) + times * many, many, sequence))
            at[c] += times * many
        sequence += times
    return Plan(slots, sequence, {int(c) + 1: int(at[c]) for c in np.flatnonzero(left)})


# ---------------------------------------------------------------- assignment


def _ranked(pieces: DataFrame, unit: int) -> DataFrame:
    """``pieces`` with their ``size_class`` and their ``rank`` in it, from 0, by falling length."""
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classed = pieces.withColumn("size_class", F.ceil(F.col("length") / unit).cast("int"))
    # pieces of one length are told apart by the row they were written as, so a length that many have is many ranges
    keys = ["size_class", F.desc("length"), F.xxhash64("piece"), "piece"]
    moved = classed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    moved = materialise(moved.withColumn("__at", F.monotonically_increasing_id()), "packing-ranked")
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    held = moved.groupBy(part.alias("__part"), "size_class").agg(F.count(F.lit(1)).alias("__n"), F.min(row).alias("__first"))
    before = "sum(__n) OVER (PARTITION BY size_class ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - __n - __first"
    base = held.select("__part", "size_class", F.expr(before).alias("__base"))
    # classes are ranges of the order, so there are at most as many rows as partitions and classes together
    joined = moved.withColumn("__part", part).join(F.broadcast(base), ["__part", "size_class"])
    return joined.withColumn("rank", F.col("__base") + row).drop("__part", "__base", "__at")


def _assigned(ranked: DataFrame, plan: Plan) -> DataFrame:
    """``ranked`` with ``sequence_id`` and ``slot``; loose pieces have none."""
    by_class: dict[int, list[tuple[int, ...]]] = {}
    for size_class, *rest in plan.slots:
        by_class.setdefault(size_class, []).append(tuple(rest))
    table = {c: np.array(rows, dtype=np.int64).T for c, rows in by_class.items()}
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("slot", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, ranks = batch.column("size_class").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.full(len(ranks), -1, dtype=np.int64), np.zeros(len(ranks), dtype=np.int64)
            for c in np.unique(classes):
                if int(c) not in table:
                    continue
                first, end, many, base = table[int(c)]
                mine = np.flatnonzero(classes == c)
                at = np.searchsorted(first, ranks[mine], side="right") - 1
                inside = ranks[mine] < end[at]
                mine, at = mine[inside], at[inside]
                sequence[mine] = base[at] + (ranks[mine] - first[at]) // many[at]
                slot[mine] = int(c) * 1_000_000 + (ranks[mine] - first[at]) % many[at]
            ids = pa.array(sequence, pa.int64(), mask=sequence < 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(slot)], names=schema.names)

    return ranked.mapInArrow(run, schema)


def _string(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int, int]]]:
    """(start, length, sequence, offset) of the parts of each piece, strung together and cut into sequences.

    They are cut every ``capacity`` ids. What remains at the end is cut into powers of two, which need no padding.
    """
    total = sum(lengths)
    edges = list(range(0, total + 1, capacity))
    at, rest = edges[-1], total - edges[-1]
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            edges.append(at)
    out, begin, k = [], 0, 0
    for n in lengths:
        parts, start = [], 0
        while start < n:
            while edges[k + 1] <= begin + start:
                k += 1
            size = min(n - start, edges[k + 1] - begin - start)
            parts.append((start, size, k, begin + start - edges[k]))
            start += size
        out.append(parts)
        begin += n
    return out


def _recut(spark: SparkSession, docs: DataFrame, loose: DataFrame, vocabulary: str, capacity: int, end_id: int, keep: list[str], text: str, first: int) -> DataFrame:
    """The parts of loose pieces, with the checksums of their ids, which are computed once more for their texts alone.

    There are fewer loose pieces than classes times the pieces of a pattern, however many documents there are, so their
    lengths may be seen by the driver and their rows be broadcast.
    """
    listed = loose.select("piece", "start", "length").orderBy("size_class", "rank").collect()
    parts = _string([r["length"] for r in listed], capacity)
    rows = [(r["piece"], r["start"] + s, n, first + k, o) for r, found in zip(listed, parts) for s, n, k, o in found]
    table = spark.createDataFrame(rows, "piece long, __start long, __length long, sequence_id long, offset long")
    cuts = loose.select("piece", *[F.col(f"`{c}`") for c in keep], "text_key", "doc_tokens").join(F.broadcast(table), "piece")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(F.xxhash64(whole, F.octet_length(whole)).alias("text_key"), whole.alias("__text"))
    texts = keyed.join(F.broadcast(loose.select("text_key").distinct()), "text_key", "left_semi").dropDuplicates(["text_key"])
    asked = F.broadcast(cuts.groupBy("text_key").agg(F.collect_set(F.struct("__start", "__length")).alias("asked")))
    last = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _words(vocabulary)
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            texts = coder.encode_all(batch.column("__text").to_pylist())
            for key, ids, cut in zip(batch.column("text_key").to_pylist(), texts, batch.column("asked").to_pylist()):
                ids = memoryview(ids + last)
                for c in cut:
                    s, n = c["__start"], c["__length"]
                    out.append((key, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
            if out:
                names = ["text_key", "__start", "__length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    sums = texts.join(asked, "text_key").select("text_key", "__text", "asked").mapInArrow(run, "text_key long, __start long, __length long, ids_crc32 long")
    named = cuts.join(sums, ["text_key", "__start", "__length"])
    return named.select(
        *[F.col(f"`{c}`") for c in keep], F.col("__start").alias("start"), F.col("__length").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def pack(
    docs: DataFrame, vocabulary: str, *, capacity: int = 4096, end_id: int = 2, unit: int = 8, keep: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """One row per piece of a document: the kept columns, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Args:
        docs: any columns; repeated rows are documents of their own, a null text is an empty one. An empty table gives no rows.
        vocabulary: path of a tokenizers file that every executor has, whose pre-tokens end at ASCII white space.
        capacity: ids of a sequence, a multiple of ``unit``.
        end_id: follows every document's ids.
        unit: width of a length class. Padding is about half of it per piece.
        keep: columns to carry along, all but the text by default. Those named like a result are left out.

    A document's pieces cover its ids once, ``start`` counts the ids before a piece, ``ids_crc32`` is the checksum of its ids as
    little-endian unsigned 32-bit integers, ``offset`` its place in the sequence, without gaps from 0. A document is cut where a sequence
    is full, and only if it is longer than one or among the last ones that fit no pattern.
    """
    results = ["text_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "piece", "size_class", "rank", "slot"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in results and c != text]
    cut = cut_documents(docs, vocabulary, capacity, end_id, kept, text).withColumn("piece", F.monotonically_increasing_id())
    pieces = materialise(cut, "packing-pieces")
    units = capacity // unit
    counts = pieces.groupBy(F.ceil(F.col("length") / unit).cast("int").alias("c")).count().collect()  # a row per class at most
    demand = np.zeros(units, dtype=np.int64)
    for r in counts:
        demand[r["c"] - 1] = r["count"]
    plan = plan_sequences(demand, units)
    assigned = materialise(_assigned(_ranked(pieces, unit), plan), "packing-assigned")
    names = [*[F.col(f"`{c}`") for c in kept], "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    before = "coalesce(sum(length) OVER (PARTITION BY sequence_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    packed = assigned.where("sequence_id is not null").select(*names, F.expr(before).alias("offset"))
    loose = assigned.where("sequence_id is null")
    if not plan.loose:
        return packed
    return packed.unionByName(_recut(docs.sparkSession, docs, loose, vocabulary, capacity, end_id, kept, text, plan.sequences))
