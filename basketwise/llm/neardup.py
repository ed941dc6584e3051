"""Near-duplicate vectors by sorted projection passes.

Each pass orders the vectors of a label lexicographically by the signs of their projections on random directions, and
compares each with a bounded number of neighbours in that order. Near vectors agree in most signs, so they are neighbours in some
pass. Projections start from the label's mean direction, so that signs also tell vectors apart that share a direction. Verified pairs
are united to components. Rounds of passes go on, each with new directions, in the labels where the last one found a link between
components. Then the links inside each component are counted exactly, in blocks. Equal vectors are one node with a weight.

A pass moves each vector once, compares ``window`` times as many pairs as there are vectors, and hands on at most two links per vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketwise.llm.components import components
from basketwise.session import materialise

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BITS = 48
_BLOCK = 512
_MARGIN = 1e-4  # error of a cosine in single precision, amply
_AT_ONCE = 3  # passes in one job, each of which shuffles all vectors
_RANGE = 16  # windows in a range of a pass, at least


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``."""
    carried: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if carried is None else pa.concat_tables([carried, table])
        keys = table.column(key).to_numpy()
        start = int(np.flatnonzero(keys == keys[-1])[0])
        if start:
            yield table.slice(0, start)
        carried = table.slice(start)
    if carried is not None:
        yield carried


def _means(nodes: DataFrame) -> DataFrame:
    """(label, size, mean): the mean of the unit vectors, summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            labels, sizes = batch.column("label").to_numpy(), batch.column("size").to_numpy()
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                units = _unit(_matrix(batch.column("vector").take(pa.array(mine)), int(size)))
                units[~np.isfinite(units).all(axis=1)] = 0  # squares too small for doubles
                order = np.argsort(labels[mine], kind="stable")
                found, first = np.unique(labels[mine][order], return_index=True)
                for label, part in zip(found.tolist(), np.split(units[order], first[1:])):
                    total = sums.setdefault((label, int(size)), [np.zeros(int(size)), 0])
                    total[0] += part.sum(axis=0)
                    total[1] += len(part)
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([sums[k][0] for k in keys], pa.list_(pa.float64())), pa.array([sums[k][1] for k in keys], pa.int64())],
            names=["label", "size", "total", "n"],
        )

    parts = nodes.select("label", "size", "vector").mapInArrow(run, "label long, size int, total array<double>, n long")
    cells = parts.select("label", "size", "n", F.posexplode("total").alias("place", "x"))
    # rounded: the order of the tasks' sums does not reach the signs
    cells = cells.groupBy("label", "size", "place").agg(F.round(F.sum("x") / F.sum("n"), 9).alias("x"))
    cells = cells.groupBy("label", "size").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("cells"))
    return cells.select("label", "size", F.col("cells.x").alias("mean"))


def _keys(nodes: DataFrame, passes: int, seed: list[int]) -> DataFrame:
    """Replaces ``mean`` by ``keys``: per pass the signs of the projections from the mean, as one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = 1 << np.arange(_BITS, dtype=np.int64)[::-1]
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            keys = np.zeros((batch.num_rows, passes), np.int64)
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                vectors = _unit(_matrix(batch.column("vector").take(pa.array(mine)), int(size)))
                vectors -= _matrix(batch.column("mean").take(pa.array(mine)), int(size))
                planes = np.random.default_rng([*seed, int(size)]).standard_normal((passes, _BITS, int(size)))
                for p in range(passes):
                    keys[mine, p] = (vectors @ planes[p].T > 0) @ places
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * passes, pa.int32()), pa.array(keys.ravel()))
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=[*(f.name for f in kept), "keys"])

    kept = [f for f in nodes.schema.fields if f.name != "mean"]
    return nodes.mapInArrow(run, T.StructType([*kept, T.StructField("keys", T.ArrayType(T.LongType()))]))


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what ``u`` and ``v`` do: each end with the smallest one that it reaches."""
    ends, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    low, high = at[: len(u)], at[len(u) :]
    root = np.arange(len(ends))
    while True:
        least = np.minimum(root[low], root[high])
        now = root.copy()
        # the roots are lowered too, so that the rounds grow with the logarithm of the longest chain
        for place in (low, high, root[low], root[high]):
            np.minimum.at(now, place, least)
        now = now[now]
        if (now == root).all():
            break
        root = now
    other = np.flatnonzero(root != np.arange(len(ends)))
    return ends[other], ends[root[other]]


def _neighbours(ordered: DataFrame, window: int, least: float) -> DataFrame:
    """(u, v, label, size): links between the components of near vectors at most ``window`` places apart, and some farther ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch]).combine_chunks()
            carried = 0 if before is None else before.num_rows
            table = table if before is None else pa.concat_tables([before, table])
            before = table.slice(max(0, table.num_rows - window))
            component, label, sizes = (table.column(c).to_numpy() for c in ("component", "label", "size"))
            vectors = table.column("vector").combine_chunks()
            for size in np.unique(sizes[carried:]):
                mine = np.flatnonzero(sizes == size)
                units = _unit(_matrix(vectors.take(pa.array(mine)), int(size)))
                rough = units.astype(np.float32)
                links = []
                for start in range(int(np.searchsorted(mine, carried)), len(mine), window):
                    a, b = mine[start : start + window], mine[max(0, start - window) : start + window]
                    product = rough[start : start + window] @ rough[max(0, start - window) : start + window].T
                    near = (product >= least - _MARGIN) & (label[a][:, None] == label[b]) & (component[a][:, None] != component[b])
                    x, y = np.nonzero(near & (a[:, None] > b))
                    close = product[x, y] < least + _MARGIN  # single precision cannot tell
                    x, y, sure = x + start, y + max(0, start - window), ~close
                    sure[close] = np.einsum("ij,ij->i", units[x[close]], units[y[close]]) >= least
                    links.append((mine[x[sure]], mine[y[sure]]))
                u, v = (np.concatenate(side) for side in zip(*links))
                for own in np.unique(label[u]):
                    ours = label[u] == own
                    high, low = _forest(component[u[ours]], component[v[ours]])
                    yield pa.RecordBatch.from_pydict({
                        "u": high, "v": low, "label": np.full(len(high), own, np.int64), "size": np.full(len(high), size, np.int32),
                    })

    return ordered.mapInArrow(run, "u long, v long, label long, size int")


def _linked(nodes: DataFrame, least: float, passes: int, window: int, seed: int) -> DataFrame:
    """(id, component) of the nodes that have links, from rounds of passes."""
    spark = nodes.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    active = materialise(_means(nodes), "vector-means")
    named, turn = None, 0
    while True:
        own = F.col("node")
        rows = nodes.join(active, ["label", "size"])
        if named is not None:
            rows = rows.join(named, rows["node"] == named["id"], "left")
            own = F.coalesce("component", "node")
        rows = rows.select("node", own.alias("component"), "label", "size", "vector", "mean")
        keyed = materialise(_keys(rows, passes, [seed, turn]), "vectors")
        # few ranges: neighbours in two of them do not meet in that pass
        parts = max(1, min(ranges, keyed.count() // (_RANGE * window)))
        links, done = None, []
        for p in range(passes):
            key = keyed.select("label", "size", F.col("keys")[p].alias("key"), "node", "component", "vector")
            ordered = key.repartitionByRange(parts, "label", "size", "key", "node").sortWithinPartitions("label", "size", "key", "node")
            found = _neighbours(ordered.select("component", "label", "size", "vector"), window, least)
            links = found if links is None else links.unionByName(found)
            if p % _AT_ONCE == _AT_ONCE - 1 or p == passes - 1:
                done.append(materialise(links, "vector-links"))
                links = None
        links = reduce(DataFrame.unionByName, done)
        if links.isEmpty():
            return spark.createDataFrame([], "id long, component long") if named is None else named
        ends = links.select("u", "v")
        ends = ends if named is None else ends.unionByName(named.select(F.col("id").alias("u"), F.col("component").alias("v")))
        named = materialise(components(ends), "vector-components")
        active = materialise(active.join(links.select("label", "size").distinct(), ["label", "size"], "left_semi"), "vector-means")
        turn += 1


def _counts(members: DataFrame, least: float) -> DataFrame:
    """(node, links) of the nodes in each pair of blocks of a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "task"):
            task, node, weight, block, i, j, label, sizes = (
                table.column(c).to_numpy() for c in ("task", "node", "weight", "block", "i", "j", "label", "size")
            )
            vectors = table.column("vector").combine_chunks()
            edges = [0, *(np.flatnonzero(np.diff(task)) + 1), len(task)]
            nodes, links = [], []
            for a, b in zip(edges, edges[1:]):
                # tasks are told apart by a hash: compare only within a label, size and pair of blocks
                kinds = np.unique(np.stack([label[a:b], sizes[a:b], i[a:b], j[a:b]], axis=1), axis=0)
                for kind in kinds:
                    mine = a + np.flatnonzero((np.stack([label[a:b], sizes[a:b], i[a:b], j[a:b]], axis=1) == kind).all(axis=1))
                    units = _unit(_matrix(vectors.take(pa.array(mine)), int(kind[1])))
                    left, right = np.flatnonzero(block[mine] == kind[2]), np.flatnonzero(block[mine] == kind[3])
                    near = units[left] @ units[right].T >= least
                    if kind[2] == kind[3]:
                        np.fill_diagonal(near, False)
                    else:
                        nodes.append(node[mine[right]])
                        links.append(near.T @ weight[mine[left]])
                    nodes.append(node[mine[left]])
                    links.append(near @ weight[mine[right]])
            yield pa.RecordBatch.from_pydict({"node": np.concatenate(nodes), "links": np.concatenate(links).astype(np.int64)})

    return members.mapInArrow(run, "node long, links long")


def near_duplicates(vectors: DataFrame, *, least: float = 0.98, passes: int = 12, window: int = 256, seed: int = 7,
                    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id and kept.

    Two vectors link if their labels are equal and their cosine, in double precision, is at least ``least``. Those that
    have no id, no label or no vector, that are zero, or that hold nulls or non-finite numbers, link with nothing; so do vectors of
    different lengths. ``n_links`` counts the other linked vectors of the component, equal ones and repeated rows too;
    ``component_id`` is the smallest id that found links reach (the own one without any), ``kept`` tells whether it is the own.
    Each round makes ``passes`` passes; a label leaves after a round that found no link between two of its components. Links between
    components that no pass brought within ``window`` places of each other, in one range of its order, are missed: few, as a
    round that finds none of several missing links is unlikely. Other columns are ignored.
    """
    spark = vectors.sparkSession
    vector = F.col(f"`{embedding}`")
    vector = vector if vectors.schema[embedding].dataType == T.ArrayType(T.FloatType()) else vector.cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    fit = F.coalesce(good & F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull(), F.lit(False))
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.when(fit, vector).alias("vector"),
    )
    grouped = rows.where("vector is not null").groupBy("label", "vector").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")
    )
    nodes = grouped.select("label", "vector", "node", "weight", F.size("vector").alias("size"))
    nodes = materialise(nodes, "vector-nodes")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # a pass's shuffle goes with its job
    try:
        named = _linked(nodes, least, passes, window, seed)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)

    sized = nodes.join(named, F.col("node") == F.col("id"), "left")
    sized = sized.select("node", "weight", "label", "size", "vector", F.coalesce("component", "node").alias("component"))
    many = sized.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
    placed = sized.join(many.where("n > 1"), "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    pairs = pairs.withColumn("task", F.xxhash64("component", "i", "j"))
    pairs = pairs.select("task", "node", "weight", "block", "i", "j", "label", "size", "vector")
    counted = _counts(pairs.repartition("task").sortWithinPartitions("task"), least)
    counted = counted.groupBy("node").agg(F.sum("links").alias("links"))
    facts = nodes.select("label", "vector", "node", "weight").join(counted, "node", "left")
    facts = facts.join(named, F.col("node") == F.col("id"), "left").select(
        F.col("label").alias("__label"), F.col("vector").alias("__vector"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"),
    )
    joined = rows.join(facts, (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
