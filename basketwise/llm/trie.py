"""Prefix trie of conversations, and sums over its subtrees by parallel tree contraction.

A node is a distinct sequence of first turns. Prefixes are told apart by 128-bit hashes that are chained along a conversation,
so no text but a turn's own is hashed and none is moved. Sums over subtrees take rounds of two steps: rake adds every leaf to
its parent, and compress removes nodes with a single child, no two next to each other, from their chains. A chain of
k nodes is gone after about log2(k) rounds, a bushy tree after its depth between branchings. The nodes that compress took out are put back in
reverse order, and take the total of the child they had then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketwise.session import materialise

_WORDS = r"[^\x20\x09-\x0D]+"
_ROOT = b"\0" * 16
_IDS = 4096  # ids per piece of a list of members
_HOT = 1000  # rows of one key that a join leaves together


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, place, digest, words): the turns of each conversation from place 1 on, by 128-bit digest and number of words.

    They are ordered by turn (null first), then by role and digest, so ties have one order. A null role or text is an empty one. Rows
    without conv_id belong to no conversation. Repeated rows are turns of their own. The text itself is not shuffled.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary")))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(_WORDS)).cast("long").alias("words")
    )
    place = F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, digest)")
    return rows.select("conv_id", place.alias("place"), "digest", "words")


def graft(own: DataFrame, head_of: Column, head_turns: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another one, to give them shared beginnings.

    Args:
        own: as from ``numbered_turns``.
        head_of: id of the other conversation, from ``conv_id``; one that is not there has no turns.
        head_turns: how many turns are replaced, from ``conv_id``, at most ``most``. A shorter head gives all its turns; own turns
            up to that number go in any case.

    Returns the turns (conv_id, place, digest, words) and (conv_id, size) of every conversation, those without turns included.
    """
    first = F.array_sort(F.collect_list(F.struct("place", "digest", "words")))
    heads = own.where(F.col("place") <= most).groupBy(F.col("conv_id").alias("__head")).agg(first.alias("__first"))
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("__n")).select("*", head_of.alias("__head"), head_turns.alias("__h"))
    sizes = sizes.join(heads, "__head", "left")
    sizes = materialise(sizes.select("conv_id", "__n", "__h", F.slice(F.coalesce("__first", F.expr("array()")), F.lit(1), F.col("__h")).alias("__first")), "trie-heads")
    given = sizes.select("conv_id", F.inline("__first"))
    shift = F.col("place") - F.col("__h") + F.size("__first")
    kept = own.join(sizes, "conv_id").where("place > __h").select("conv_id", shift.cast("int").alias("place"), "digest", "words")
    size = F.size("__first") + F.greatest(F.col("__n") - F.col("__h"), F.lit(0))
    return given.unionByName(kept), sizes.select("conv_id", size.cast("int").alias("size"))


def prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, words, ends): one row per prefix of each conversation, the empty one included.

    A task walks through sorted turns and carries one hash from row to row, so a long conversation needs no memory.
    """
    ends = F.col("depth") == F.col("size")
    rows = turns.join(sizes, "conv_id").select("conv_id", F.col("place").cast("int").alias("depth"), "digest", "words", (F.col("place") == F.col("size")).alias("ends"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key = None, _ROOT
        for batch in batches:
            keys, parents = [], []
            for conv, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()):
                if conv != now:
                    now, key = conv, _ROOT
                parents.append(key)
                key = hashlib.blake2b(key + digest, digest_size=16).digest()
                keys.append(key)
            columns = [batch.column("conv_id"), batch.column("depth"), pa.array(keys, pa.binary()), pa.array(parents, pa.binary())]
            names = ["conv_id", "depth", "key", "parent", "words", "ends"]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("words"), batch.column("ends")], names=names)

    walked = ordered.mapInArrow(run, "conv_id long, depth int, key binary, parent binary, words long, ends boolean")
    empty = sizes.select("conv_id", F.lit(0).alias("depth"), "size")
    tops = empty.select("conv_id", "depth", F.lit(_ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("words"), ends.alias("ends"))
    return walked.unionByName(tops)


def _member_hashes(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the comma-joined, ascending ids of (key, conv_id).

    The ids of one key may be a third of all: they are sorted over all tasks, joined to texts of some thousand ids there, and
    only these texts pass through the one task that computes the key's hash, one after the other.
    """
    ordered = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []
        for batch in batches:
            out: list[tuple[bytes, int, str]] = []
            for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (key != now or len(ids) == _IDS):
                    out.append((now, ids[0], ",".join(map(str, ids))))
                    ids = []
                now = key
                ids.append(conv)
            if out:
                yield _batch(out, [("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
        if ids:
            yield _batch([(now, ids[0], ",".join(map(str, ids)))], [("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out: list[tuple[bytes, str]] = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if state is not None and key == now:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            if out:
                yield _batch(out, [("key", pa.binary()), ("ends_sha256", pa.string())])
        if state is not None:
            yield _batch([(now, state.hexdigest())], [("key", pa.binary()), ("ends_sha256", pa.string())])

    joined = ordered.mapInArrow(join, "key binary, first long, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` with a table of unique keys. A key that very many rows ask for is dealt over several tasks.

    Such keys have over 1/10,000 of all rows (and over 1,000), so there are at most 10,000 of them: a broadcast of proven size.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    limit = max(_HOT, (rows.count() + 9_999) // 10_000)
    hot = F.broadcast(counts.where(F.col("__n") > limit).select(key, F.ceil(F.col("__n") / limit).cast("int").alias("__parts")))
    salted = rows.join(hot, key, "left").withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("__parts")).cast("int"), F.lit(0)))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1))
    spread = table.join(hot, key, "left").withColumn("__salt", copies)
    return salted.drop("__parts").join(spread.drop("__parts"), [key, "__salt"], "left").drop("__salt")


def _sent(rows: DataFrame, messages: list[dict[str, Column]], types: dict[str, str]) -> DataFrame:
    """Every row's messages (columns they lack are null) as rows of their own; those without ``id`` are not sent."""
    full = [F.struct(*[m.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()]) for m in messages]
    return rows.select(F.inline(F.array(*full))).where("id is not null")


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """(id, *values): the sums of each value over every node's subtree, its top included.

    Args:
        tree: ``id`` (long), ``parent`` (null at a top), ``depth`` (at least 1 below a top; it only steers which nodes of a chain go first), and
            the values (long). Several trees are fine.

    A round is three groupings of messages that nodes send to themselves, their parent and their child, so a node with
    very many children receives partial sums. Each is written as a table; the driver sees one flag per round.
    """
    own = {"id": "long", "parent": "long", "depth": "int"} | dict.fromkeys(values, "long")
    me = {c: F.col(c) for c in own}
    given = {v: F.col(v) for v in values}
    merged = [F.max("parent").alias("parent"), F.max("depth").alias("depth"), *[F.sum(v).alias(v) for v in values]]
    state, rounds = tree.select(*own), []
    while True:
        # how many children, and which, if one
        asked = _sent(state, [me, {"id": F.col("parent"), "child": F.col("id")}], own | {"child": "long"})
        counted = asked.groupBy("id").agg(*merged, F.count("child").alias("n"), F.min("child").alias("child"))
        # a node with one child tells its neighbours its rank: in a fresh chain every second node has the least; equal ranks wait
        zeros = F.bit_count(F.col("depth").bitwiseAND(-F.col("depth")) - 1).cast("long")
        rank = F.shiftleft(zeros, 57) + F.shiftrightunsigned(F.xxhash64("id", F.lit(len(rounds))), 7)
        unary = (F.col("n") == 1) & F.col("parent").isNotNull()
        ranked = counted.withColumn("rank", F.when(unary, rank))
        told = _sent(
            ranked,
            [
                me | {"n": F.col("n"), "child": F.col("child"), "rank": F.col("rank"), "leaf": F.lit(0)},
                {"id": F.when(unary, F.col("parent")), "rival": F.col("rank")},
                {"id": F.when(unary, F.col("child")), "rival": F.col("rank")},
                {"id": F.when(F.col("n") == 0, F.col("parent")), "leaf": F.lit(1)},
            ],
            own | {"n": "long", "child": "long", "rank": "long", "rival": "long", "leaf": "int"},
        ).groupBy("id").agg(*merged, *[F.max(c).alias(c) for c in ("n", "child", "rank", "leaf")], F.min("rival").alias("rival"))
        # a single child that is a leaf is raked now, so its parent waits
        taken = F.col("rank").isNotNull() & (F.col("leaf") == 0) & (F.col("rival").isNull() | (F.col("rank") < F.col("rival")))
        step = F.when(F.col("n") == 0, "rake").when(taken, "compress").otherwise("stay").alias("step")
        done = materialise(told.select(*own, "child", step), "trie-round")
        rounds.append(done)
        if done.where("step <> 'rake'").isEmpty():
            break
        stays, moves = F.col("step") == "stay", F.col("step") == "compress"
        state = _sent(
            done,
            [
                me | {"id": F.when(stays, F.col("id"))},
                given | {"id": F.when(~stays, F.col("parent"))},
                {"id": F.when(moves, F.col("child")), "moved": F.col("parent")},
            ],
            own | {"moved": "long"},
        ).groupBy("id").agg(*merged, F.max("moved").alias("moved"))
        state = state.select("id", F.coalesce("moved", "parent").alias("parent"), "depth", *values)
    totals = None  # of the nodes that later rounds took out; a compressed node's child is one of them
    for done in reversed(rounds):
        now = done.where("step = 'rake'").select("id", *values)
        if totals is not None:
            child = totals.select(F.col("id").alias("child"), *[F.col(v).alias(f"__{v}") for v in values])
            back = done.where("step = 'compress'").join(child, "child")
            back = materialise(back.select("id", *[(F.col(v) + F.col(f"__{v}")).alias(v) for v in values]), "trie-expanded")
            now = totals.unionByName(now).unionByName(back)
        totals = now
    return totals


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nodes of the trie over conversations.

    Args:
        turns: (conv_id, place, digest, words), as from ``numbered_turns`` or ``graft``.
        sizes: (conv_id, size) of all conversations; those without turns are members of the root alone.

    Returns conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless
    nodes in the subtree), saved_tokens (over the subtree, the words of a node's last turn for every member but one),
    ends_sha256 (of the ids of members that end here). No conversations give no nodes.
    """
    rows = materialise(prefixes(turns, sizes), "trie-prefixes")
    nodes = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.max("parent").alias("parent"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words")
    )
    nodes = materialise(nodes.withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    upper = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("id").alias("up"))
    placed = materialise(_look_up(nodes, upper, "parent").drop("parent"), "trie-parents")
    children = placed.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    placed = placed.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    tree = placed.select("id", F.col("up").alias("parent"), "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), saved)
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"])
    hashes = _member_hashes(rows.where("ends").select("key", "conv_id"))
    return placed.join(sums, "id").join(hashes, "key", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
