"""Shards of nearly equal bytes by histogram sort, with DataFrame functions only.

Documents are ordered by a hash of their text, so equal texts are neighbours. A shard is a range of that order. The
bytes below candidate boundaries are counted exactly over all rows, and each boundary's interval is cut into 256 again
and again until the bytes below it are as near to the wanted number as the tolerance asks. Then the rows move once.

Groups of equal texts stay in one shard. Those with more than ``tolerance`` of a shard's bytes (so at most
``shards / tolerance`` of them) are placed first, the largest to the emptiest shard; the ranges fill up the rest. Only a
group larger than a whole shard is cut: its rows are numbered, and ordered by a hash of their number like single texts.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwise.session import materialise

_BITS = 8
_LOWEST = -(1 << 63)


def _splitters(groups: DataFrame, wanted: list[float], slack: float) -> list[int]:
    """Keys below which the wanted bytes lie, up to ``slack`` or to the bytes of one key.

    ``groups``: (place long, bytes long). Each round counts at most 256 candidates per boundary, over all rows.
    """
    bits = 64 - _BITS
    found: list[int | None] = [None] * len(wanted)
    low, below = [_LOWEST] * len(wanted), [0] * len(wanted)
    while None in found:
        asked = sorted({low[i] for i, key in enumerate(found) if key is None})
        span = 1 << (bits + _BITS)
        inside = [F.col("place") >= a if a + span > (1 << 63) - 1 else F.col("place").between(a, a + span - 1) for a in asked]
        if span == 1 << 64:
            step = F.shiftright("place", bits) + (1 << (_BITS - 1))
        else:
            base = F.coalesce(*[F.when(c, F.lit(a)) for a, c in zip(asked, inside)])
            step = F.shiftright(F.col("place") - base, bits)
        which = F.coalesce(*[F.when(c, F.lit(n)) for n, c in enumerate(inside)])
        counted = groups.where(which.isNotNull()).groupBy(which.alias("which"), step.alias("step")).agg(F.sum("bytes").alias("b"))
        counts = {(r["which"], r["step"]): r["b"] for r in counted.collect()}
        for i, key in enumerate(found):
            if key is not None:
                continue
            which_of, have = asked.index(low[i]), below[i]
            for s in range(1 << _BITS):
                more = counts.get((which_of, s), 0)
                edge = low[i] + (s << bits)
                if have + more >= wanted[i] or s == (1 << _BITS) - 1:
                    near = min((wanted[i] - have, edge), (have + more - wanted[i], edge + (1 << bits)), key=lambda x: abs(x[0]))
                    if abs(near[0]) <= slack or bits == 0:
                        found[i] = near[1]
                    else:
                        low[i], below[i] = edge, have
                    break
                have += more
        bits -= _BITS
    return [k for k in found if k is not None]


def _level(loads: list[int], free: int) -> float:
    """The height to which ``free`` more bytes fill up the loads."""
    level, order = 0.0, sorted(loads)
    for n in range(1, len(order) + 1):
        level = (free + sum(order[:n])) / n
        if n == len(order) or level <= order[n]:
            break
    return level


def _shard_of(place: Column, splitters: list[int], big: dict[int, int], text_key: Column) -> Column:
    out = F.lit(0)
    for key in splitters:
        out = out + (F.lit(False) if key > (1 << 63) - 1 else place >= F.lit(key)).cast("int")
    if not big:
        return out
    fixed = F.create_map(*[F.lit(x) for pair in big.items() for x in pair])
    return F.coalesce(fixed[text_key], out)


def shard_by_bytes(
    docs: DataFrame, shards: int, *, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, tolerance: float = 1 / 64
) -> DataFrame:
    """Every document with its ``shard`` (0 to ``shards - 1``) and its ``slot`` there (gapless from 0).

    Args:
        docs: any columns; repeated rows are documents of their own, a null text counts as an empty one, a null id sorts
            first. An empty table gives an empty result.
        keep: columns to carry along besides the results; all by default.
        tolerance: groups of equal texts with more than this part of a shard's bytes are placed one by one; boundaries
            are a sixteenth of it exact, if single groups allow.

    Returns the kept columns, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard`` and ``slot``. Columns of ``docs`` with these
    names are replaced. Sizes of shards differ by the tolerance at most unless one document is larger.
    """
    results = ["size", "text_crc32", "shard", "slot"]
    kept = [c for c in (keep or docs.columns) if c not in results]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.col(f"`{doc_id}`").alias("__id"),
        F.xxhash64(whole).alias("__key"),
    )
    sums = keyed.groupBy("__key").agg(F.sum("size").alias("bytes"))
    groups = materialise(sums, "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    share = total / shards
    large = groups.where(F.col("bytes") > share * tolerance).orderBy(F.desc("bytes"), "__key").collect()  # shards / tolerance at most
    giant = [r["__key"] for r in large if r["bytes"] > share]
    loads, big = [0] * shards, {}
    for r in large:
        if r["__key"] not in giant:
            shard = min(range(shards), key=lambda s: (loads[s], s))
            big[r["__key"]] = shard
            loads[shard] += r["bytes"]
    cut = F.col("__key").isin(giant) if giant else F.lit(False)
    if large:
        # ids can be missing or repeated, so rows of large groups get a number, stored with them: a retried task reads the same
        listed = F.col("__key").isin([r["__key"] for r in large])
        numbered = materialise(keyed.where(listed).withColumn("__n", F.monotonically_increasing_id()), "shard-large")
        keyed = keyed.where(~listed).withColumn("__n", F.lit(0).cast("long")).unionByName(numbered)
    else:
        keyed = keyed.withColumn("__n", F.lit(0).cast("long"))
    place = F.when(cut, F.xxhash64("__n", "__key")).otherwise(F.col("__key"))
    pool = groups.where(~F.col("__key").isin([r["__key"] for r in large])) if large else groups
    pool = pool.select(F.col("__key").alias("place"), "bytes")
    if giant:
        single = keyed.where(cut).groupBy(place.alias("place")).agg(F.sum("size").alias("bytes"))
        pool = materialise(pool.unionByName(single), "shard-pool")
    level = _level(loads, total - sum(loads))
    wanted = list(accumulate(max(0.0, level - load) for load in loads))[:-1]
    splitters = _splitters(pool, wanted, share * tolerance / 16) if total else [0] * (shards - 1)

    placed = keyed.select("*", place.alias("__place"), _shard_of(place, splitters, big, F.col("__key")).alias("shard"))
    parts = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["shard", "__place", "__n", "__id"]
    moved = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    moved = materialise(
        moved.select(*[F.col(f"`{c}`") for c in kept], "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("__at")),
        "shard-rows",
    )
    # the partition and the row within it are in __at; a partition's first slot is what the earlier ones hold of the shard
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    held = moved.groupBy(part.alias("__part"), "shard").agg(F.count(F.lit(1)).alias("__n"), F.min(row).alias("__first"))
    from_zero = "sum(__n) OVER (PARTITION BY shard ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - __n - __first"
    base = held.select("__part", "shard", F.expr(from_zero).alias("__base"))
    joined = moved.withColumn("__part", part).join(F.broadcast(base), ["__part", "shard"])  # a row per partition and shard at most
    return joined.select(*[F.col(f"`{c}`") for c in kept], "size", "text_crc32", "shard", (F.col("__base") + row).alias("slot"))
