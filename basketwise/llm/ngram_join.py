"""Exact Jaccard join of documents' word n-gram sets, with set-relation skipping.

1. Every set is hashed once; equal sets are one node, whose id is their smallest document.
2. Answers of very similar sets: sets that share minima of several hashes are compared with the smallest set among
   them (its leader), one comparison per set and shared minimum. Verified links join them into components, and the
   overlap with the leader is kept.
3. Index: the grams of each set are ordered by how many sets have them, and only the first are listed; a pair that reaches the
   threshold shares one of these. Grams of one set come first and need no list, which leaves many sets without any. Lists whose sets are one component already are skipped as a whole, within the others
   blocks are skipped by set size and position, as far as their bound rules them out.
4. Pairs found there whose parity bitmaps differ in too many bits cannot reach the threshold and are dropped. For the others the
   leaders are compared first. The overlap of two members follows from that of their leaders up to the
   few grams in which they differ: most pairs are decided by these bounds, the rest is compared exactly.

Links within a component found before are not listed again: the result is the classes, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwise.llm import seeds
from basketwise.llm.arrow import gram_hashes, text_chunks, word_hashes, words
from basketwise.llm.components import components
from basketwise.session import materialise

_SEEDS = [0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
_OFTEN = 3  # a gram in so many sets of one chunk is counted as frequent
_FREQUENT = 1 << 16  # frequent grams that are told apart in the order of grams
_GRAMS = 500_000  # per bucket
_BLOCK = 512
_META = "doc_id long, text_key long, n_shingles long, digest binary, sid long, minima array<long>, bits binary, frequent binary"
_GRAM = np.dtype([("key", "<u8"), ("sets", "<u4")])


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted gram hashes of each text."""
    starts, ends, first = words(data, offsets)
    hashes = word_hashes(data, starts, ends, lower=True)
    grams = gram_hashes(hashes, k)
    for a, b in zip(first, first[1:]):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        else:
            yield gram_hashes(hashes[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64)


def _digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _parities(grams: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of grams fall on it; two bits per gram, or some more."""
    size = 1 << max(6, (2 * len(grams) - 1).bit_length())
    counts = np.bincount((grams >> np.uint64(20)).astype(np.int64) & (size - 1), minlength=size)
    return np.packbits(counts & 1).tobytes()


def _differ(x: bytes, y: bytes) -> int:
    """Bits in which two parity maps differ: at most as many as the grams that only one of the sets has."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (a, b))  # places are taken modulo the size
    return int(np.bitwise_count(a ^ b).sum())


def _measure(docs: DataFrame, k: int) -> DataFrame:
    """Per document the size, identity and hash minima of its set; besides, rows with the frequent grams of a chunk."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sid", pa.int64()),
         ("minima", pa.list_(pa.int64())), ("bits", pa.binary()), ("frequent", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(2)
            for low, high, data, offsets in text_chunks(batch.column(1)):
                sizes, digests, minima, bits, distinct = [], [], [], [], {}
                for grams in _sets(data, offsets, k):
                    sizes.append(len(grams))
                    digests.append(_digest(grams) if len(grams) else None)
                    minima.append([int((grams * np.uint64(s)).min().view(np.int64)) for s in _SEEDS] if len(grams) else [])
                    bits.append(_parities(grams) if len(grams) else None)
                    distinct[digests[-1]] = grams
                seen, count = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                often = count >= _OFTEN
                packed = np.rec.fromarrays([seen[often], count[often].astype(np.int64)]).tobytes()
                sid = [None if d is None else int.from_bytes(d[:8], "little", signed=True) for d in digests]
                rows = [*(c.slice(low, high - low).to_pylist() + [None] for c in (ids, keys)), sizes + [None], digests + [None], sid + [None],
                        minima + [None], bits + [None], [None] * len(sizes) + [packed]]
                yield pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, schema)], schema=schema)

    return docs.mapInArrow(run, _META)


def _frequent(measured: DataFrame) -> np.ndarray:
    """The most frequent grams, rising; it only sets the order of grams, not what is found. Bounded by ``_FREQUENT``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=[("gram", "<i8"), ("n", "<i8")])
            yield pa.RecordBatch.from_pydict({"gram": packed["gram"].copy(), "n": packed["n"].copy()})

    each = measured.where("frequent is not null").select("frequent").mapInArrow(unpack, "gram long, n long")
    top = each.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(_FREQUENT)
    return np.array([r["gram"] for r in top.collect()], dtype=np.int64).view(np.uint64)[::-1].copy()


def _shared(docs: DataFrame, k: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """(sid, grams) of the grams that several sets have, with the number of sets; frequent ones count as most."""
    by_value = np.argsort(frequent)
    values = frequent[by_value]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                sets = {int.from_bytes(_digest(g)[:8], "little", signed=True): g for g in _sets(data, offsets, k) if len(g)}
                if not sets:
                    continue
                sids = np.array(sorted(sets), np.int64)
                grams = np.concatenate([sets[s] for s in sids.tolist()])
                owner = np.repeat(sids, [len(sets[s]) for s in sids.tolist()])
                parts: list[tuple[int, int | None, bytes]] = []
                if len(values):
                    place = np.minimum(np.searchsorted(values, grams), len(values) - 1)
                    known = values[place] == grams
                    entries = np.empty(int(known.sum()), _GRAM)
                    entries["key"] = seeds.keys_of(grams[known], buckets)
                    entries["sets"] = by_value[place[known]] + (1 << 31)
                    parts += [(s % buckets, s, e) for s, e in seeds.by_text(owner[known], entries)]
                    grams, owner = grams[~known], owner[~known]
                keys = seeds.keys_of(grams, buckets)
                bucket = (keys >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                keys, owner, bucket = keys[order], owner[order], bucket[order]
                edges = np.flatnonzero(np.diff(bucket)) + 1
                for a, b in zip([0, *edges], [*edges, len(keys)]):
                    if b > a:
                        parts.append((int(bucket[a]), None, seeds.pack_by_text(owner[a:b], keys[a:b])))
                yield seeds.rows(parts)

    def settle(bucket: int, runs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        sids, low = (np.concatenate(x) for x in zip(*map(seeds.unpack_by_text, runs)))
        order = np.lexsort((sids, low))
        sids, low = sids[order], low[order]
        fresh = np.ones(len(low), bool)  # a set that several chunks hold counts once
        fresh[1:] = (low[1:] != low[:-1]) | (sids[1:] != sids[:-1])
        sids, low = sids[fresh], low[fresh]
        first = np.ones(len(low), bool)
        first[1:] = low[1:] != low[:-1]
        group = np.cumsum(first) - 1
        sets = np.bincount(group)[group]
        more = sets > 1
        entries = np.empty(int(more.sum()), _GRAM)
        entries["key"] = low[more].astype(np.uint64) | np.uint64(bucket << 32)
        entries["sets"] = sets[more]
        yield from seeds.by_text(sids[more], entries)

    return seeds.exchange(docs.select("text").mapInArrow(deal, seeds.ROWS), buckets, settle)


def _index(shared: DataFrame, nodes: DataFrame, percent: int, buckets: int) -> DataFrame:
    """(gram, rep, n, pos, comp) of the prefixes: grams of one set come first and need no list, the others by rising frequency.

    ``shared``: from ``_shared``; ``nodes``: (sid, rep, n, comp).
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, sizes, comps = (batch.column(i).to_numpy() for i in range(3))
            found: list[list[np.ndarray]] = [[], [], [], [], []]
            for rep, n, comp, data in zip(reps, sizes, comps, batch.column(3).to_pylist()):
                entries = np.unique(seeds.unpacked(data, _GRAM))  # of frequent grams each chunk with the set sent one
                length = n - (percent * n + 99) // 100 + 1
                alone = max(0, n - len(entries))
                if alone >= length:
                    continue
                keys = entries["key"][np.lexsort((entries["key"], entries["sets"]))][: length - alone]
                for column, value in zip(found, (keys.view(np.int64), rep, n, alone + np.arange(len(keys)), comp)):
                    column.append(np.broadcast_to(value, len(keys)))
            if found[0]:
                arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in found]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "rep", "n", "pos", "comp"])

    gathered = seeds.collected(shared, buckets).join(nodes, "sid").select("rep", "n", "comp", "data")
    return gathered.mapInArrow(prefixes, "gram long, rep long, n long, pos long, comp long")


def _bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, most): the sizes of a pair and what its parity bitmaps let it share at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            apart = np.array([_differ(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())], np.int64)
            most = np.minimum((n_a + n_b - apart) // 2, np.minimum(n_a, n_b))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(most, pa.int64())], names=["a", "b", "n_a", "n_b", "most"])

    of_a, of_b = (nodes.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    joined = pairs.select("a", "b").join(of_b, "b").join(of_a, "a").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return joined.mapInArrow(run, "a long, b long, n_a long, n_b long, most long")


def _overlaps(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(a, b, n_a, n_b, both) of every pair (a, b) of documents."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch.column(2), 1 << 20):
                blobs = [g.tobytes() for g in _sets(data, offsets, k)]
                ids = [batch.column(i).slice(low, high - low) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(blobs, pa.binary())], names=["a", "b", "grams"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes: list[list[int]] = [[], [], []]
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                sizes[0].append(len(x))
                sizes[1].append(len(y))
                sizes[2].append(len(np.intersect1d(x, y, assume_unique=True)))
            arrays = [pa.array(s, pa.int64()) for s in sizes]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["a", "b", "n_a", "n_b", "both"])

    members = docs.join(pairs.select("a", F.col("b").alias("doc_id")), "doc_id").select("a", F.col("doc_id").alias("b"), "text")
    leaders = docs.join(pairs.select(F.col("a").alias("doc_id")).distinct(), "doc_id")
    leaders = leaders.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"), "text")
    right = members.mapInArrow(hashed, "a long, b long, grams binary").withColumnRenamed("grams", "grams_b")
    left = leaders.mapInArrow(hashed, "a long, b long, grams binary").select("a", F.col("grams").alias("grams_a"))
    joined = right.join(left, "a").select("a", "b", "grams_a", "grams_b")
    return joined.mapInArrow(compare, "a long, b long, n_a long, n_b long, both long")


def _candidates(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a listed gram and may reach the threshold by size and position."""
    # overlap o reaches the threshold if 100 * o >= percent * (n_a + n_b - o)

    def compare(n: np.ndarray, pos: np.ndarray, comp: np.ndarray, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        order = np.argsort(n, kind="stable")
        n, pos, comp, ids = n[order], pos[order], comp[order], ids[order]
        rest = n - pos  # grams from the shared one on
        for i in range(len(n) - 1):
            stop = int(np.searchsorted(n, 100 * n[i] // percent, side="right"))
            for j in range(i + 1, stop, _BLOCK):
                block = slice(j, min(stop, j + _BLOCK))
                best = min(rest[i], rest[block].max())
                if (100 + percent) * best < percent * (n[i] + n[j]):
                    continue
                most = np.minimum(rest[i], rest[block])
                fits = ((100 + percent) * most >= percent * (n[i] + n[block])) & (comp[block] != comp[i])
                if fits.any():
                    other = ids[block][fits]
                    yield np.full(len(other), ids[i]), other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.Table | None = None

        def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
            gram, ids, n, pos, comp = (table.column(c).to_numpy() for c in ("gram", "rep", "n", "pos", "comp"))
            edges = np.flatnonzero(np.diff(gram)) + 1
            found = []
            for a, b in zip([0, *edges], [*edges, len(gram)]):
                if b - a > 1 and comp[a:b].min() != comp[a:b].max():
                    found += compare(n[a:b], pos[a:b], comp[a:b], ids[a:b])
            if found:
                x, y = (np.concatenate(z) for z in zip(*found))
                both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
                yield pa.RecordBatch.from_pydict({"a": both[:, 0].copy(), "b": both[:, 1].copy()})

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if carried is None else pa.concat_tables([carried, table])
            gram = table.column("gram").to_numpy()
            start = int(np.searchsorted(gram, gram[-1]))  # the last gram's list may go on
            yield from pairs(table.slice(0, start))
            carried = table.slice(start)
        if carried is not None:
            yield from pairs(carried)

    return lists.mapInArrow(run, "a long, b long").distinct()


def link_documents(docs: DataFrame, *, k: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text", text_key: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles (distinct ``k``-word grams) and component_id.

    ``text_key`` adds the xxhash64 of the text, which tells documents of one id apart.

    Words are runs of other than ASCII white space, lower-cased in A-Z. A text with fewer than ``k`` words is one gram; one
    without words, or null, has none and is linked with nothing. Two sets link when their overlap is at least ``percent``
    of their union. The component is the smallest id that links reach. Rows that repeat an id are one document in links; a
    row without id takes the component of an equal set, if any has an id. Other columns are ignored.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    measured = materialise(_measure(docs.withColumn("text_key", F.xxhash64("text")), k), "ngram-sets")
    meta = measured.where("frequent is null")
    sets = meta.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sid").alias("sid"),
        F.first("minima").alias("minima"), F.first("bits").alias("bits"),
    )
    sets = materialise(sets, "ngram-distinct")
    nodes = sets.where("rep is not null")

    reach = lambda o: (100 + percent) * F.col(o) >= percent * (F.col("n_a") + F.col("n_b"))
    minima = nodes.select("rep", F.posexplode("minima").alias("seed", "least"))
    leaders = minima.groupBy("seed", "least").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    close = minima.join(leaders, ["seed", "least"]).where("rep <> a").groupBy("a", F.col("rep").alias("b")).count().where("count > 1")
    close = materialise(_bounded(close, nodes).where(reach("most")).select("a", "b"), "ngram-close")
    first = materialise(_overlaps(close, docs, k).where(reach("both")), "ngram-leaders")
    stars = first.groupBy(F.col("b").alias("rep")).agg(F.max(F.struct("both", F.negative("a").alias("minus"), "n_a")).alias("best"))
    stars = stars.select(
        "rep", F.negative("best.minus").alias("leader"), F.col("best.both").alias("held"), F.col("best.n_a").alias("n_leader")
    )
    stars = materialise(stars, "ngram-stars")
    known = components(first.select(F.col("a").alias("u"), F.col("b").alias("v")))

    grams = nodes.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(grams) // _GRAMS + 1)
    labels = nodes.join(known, F.col("rep") == F.col("id"), "left")
    labels = labels.select("sid", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    lists = materialise(_index(_shared(docs, k, _frequent(measured), buckets), labels, percent, buckets), "ngram-lists")
    mixed = lists.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("gram")
    lists = lists.join(mixed, "gram").repartition("gram").sortWithinPartitions("gram")
    pairs = materialise(_candidates(lists.select("gram", "rep", "n", "pos", "comp"), percent), "ngram-pairs")

    # bounds from the leaders' overlap: what two members share beyond it lies in their own differences
    possible = _bounded(pairs, nodes).where(reach("most"))
    of_a, of_b = (
        stars.select(F.col("rep").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("leader", "held", "n_leader")]) for c in "ab"
    )
    zero = F.lit(0)
    known_by = possible.join(of_a, "a", "left").join(of_b, "b", "left").select(
        "a", "b", "n_a", "n_b", "most",
        *[F.coalesce(f"leader_{c}", c).alias(f"lead_{c}") for c in "ab"],
        *[F.coalesce(F.col(f"n_{c}") - F.col(f"held_{c}"), zero).alias(f"more_{c}") for c in "ab"],
        *[F.coalesce(F.col(f"n_leader_{c}") - F.col(f"held_{c}"), zero).alias(f"less_{c}") for c in "ab"],
    )
    known_by = materialise(known_by, "ngram-possible")
    leading = known_by.select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b")).distinct()
    lead = _overlaps(leading, docs, k).select(F.col("a").alias("lead_a"), F.col("b").alias("lead_b"), F.col("both").alias("common")).distinct()
    derived = known_by.join(lead, ["lead_a", "lead_b"]).select(
        "a", "b", "n_a", "n_b",
        F.least(F.col("common") + F.col("more_a") + F.col("more_b"), "most").alias("above"),
        (F.col("common") - F.col("less_a") - F.col("less_b")).alias("below"),
    )
    derived = materialise(derived, "ngram-derived")
    sure = derived.where(reach("below")).select("a", "b")
    later = _overlaps(derived.where(~reach("below") & reach("above")).select("a", "b").distinct(), docs, k)
    later = later.where(reach("both")).select("a", "b")
    links = first.select("a", "b").unionByName(sure).unionByName(later)
    final = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = sets.join(final, F.col("rep") == F.col("id"), "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    named = materialise(named, "ngram-components")
    keys = ["text_key"] if text_key else []
    return meta.join(named, "digest", "left").select("doc_id", *keys, "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
