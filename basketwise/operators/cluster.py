"""K-Means on scaled recency, frequency and spend, with business labels.

All starts, and all numbers of clusters of an elbow scan, run side by side: every step is one pass over the customers, which
leaves one row per task, start and centre. The passes read boxes of neighbouring customers with their sums: a box that lies
in one centre's region as a whole is added as such, only the others are opened, so the sums are those of all customers. Starts are seeded by k-means||: in a few rounds each start takes points that are
likely far from the ones it has, and picks its centres among these by weight. Draws are hashes of the customer id
and sums are whole numbers, so neither partitions nor their order change the clusters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketwise.functions.numeric import exact_mean, round_even
from basketwise.operators.rfm import METRICS, rfm_scaled
from basketwise.session import materialise

SEED = 42
STARTS = 10
SEED_ROUNDS = 3
OVERSAMPLE = 2  # points per round and wanted centre
TOLERANCE = 1e-4  # squared way of all centres at which a start has settled
UNIT = 1e9  # coordinates are summed as whole parts of 1 / UNIT
BOX = 256  # customers of a box
BOXES = 512  # boxes of a stored row
AXES = [f"{m}_z" for m in METRICS]


@dataclass
class Clustering:
    """The best start for a number of clusters: its centres in order of their coordinates, and its inertia."""

    k: int
    centres: np.ndarray
    inertia: float


def _points(metrics: DataFrame) -> DataFrame:
    return rfm_scaled(metrics).where(" AND ".join(f"{a} IS NOT NULL" for a in AXES))


def _against(points: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``points`` once per start, with the nearest of its centres (``at``, the first of equals) and the squared distance to it."""
    listed = ", ".join(
        f"named_struct('start', {start}, 'c', array({', '.join('array(' + ', '.join(f'{float(x)!r}D' for x in c) + ')' for c in rows)}))"
        for start, rows in centres.items()
    )
    distance = " + ".join(f"(c[{i}] - {axis}) * (c[{i}] - {axis})" for i, axis in enumerate(AXES))
    each = points.select("CustomerID", *AXES, F.expr(f"inline(array({listed}))"))
    near = F.expr(f"array_min(transform(c, (c, i) -> named_struct('d', {distance}, 'at', i)))")
    return each.select("CustomerID", *AXES, "start", near.alias("near")).select("CustomerID", *AXES, "start", F.col("near.at").alias("at"), F.col("near.d").alias("d"))


def _sums(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[tuple[int, int], tuple[int, list[int], int]]:
    """(start, centre) to its number of points, their summed coordinates and squared distances, as whole parts of 1 / ``UNIT``.

    As ``_against`` with groups, but a task compares its points with the centres in blocks and leaves a row per centre.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            whole = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            for low in range(0, whole.shape[1], 1 << 12):
                axes = whole[:, low : low + (1 << 12)]
                for start, rows in centres.items():
                    apart = np.zeros((len(rows), axes.shape[1]))
                    for i, axis in enumerate(axes):
                        away = rows[:, i, None] - axis
                        apart += away * away
                    at = apart.argmin(axis=0)
                    parts = np.vstack([axes, apart[at, np.arange(len(at))]])
                    parts = np.rint(parts * UNIT).astype(np.int64)
                    for j in np.unique(at).tolist():
                        mine = at == j
                        found = [int(mine.sum()), *parts[:, mine].sum(axis=1).tolist()]
                        total[start, j] = [a + b for a, b in zip(total.get((start, j), [0] * len(found)), found)]
        rows = [(start, at, *map(Decimal, numbers)) for (start, at), numbers in total.items()]
        kinds = [pa.int32(), pa.int32(), *[pa.decimal128(38, 0)] * (len(AXES) + 2)]
        names = ["start", "at", "n", *AXES, "d"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    schema = "start int, at int, " + ", ".join(f"{c} decimal(38,0)" for c in ["n", *AXES, "d"])
    sums = points.select(*AXES).mapInArrow(run, schema).groupBy("start", "at").agg(*[F.sum(c).alias(c) for c in ["n", *AXES, "d"]])
    return {(r["start"], r["at"]): (int(r["n"]), [int(r[a]) for a in AXES], int(r["d"])) for r in sums.collect()}


def _boxes(points: DataFrame) -> DataFrame:
    """Rows of boxes of ``BOX`` neighbouring points, split along their widest side: the coordinates of all points, as doubles."""

    def ordered(axes: np.ndarray) -> np.ndarray:
        order, open_ = np.arange(axes.shape[1]), [(0, axes.shape[1])]
        while open_:
            low, high = open_.pop()
            if high - low > BOX:
                mine = axes[:, order[low:high]]
                wide = mine[(mine.max(axis=1) - mine.min(axis=1)).argmax()]
                middle = -(-(high - low) // (2 * BOX)) * BOX  # whole boxes
                order[low:high] = order[low:high][np.argpartition(wide, middle)]
                open_ += [(low, low + middle), (low + middle, high)]
        return order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float))
            if sum(x.shape[1] for x in held) >= 1 << 20:  # a large task sorts its points in pieces
                yield packed(np.hstack(held))
                held = []
        if held:
            yield packed(np.hstack(held))

    def packed(axes: np.ndarray) -> pa.RecordBatch:
        axes = np.ascontiguousarray(axes[:, ordered(axes)].T)
        rows = [axes[i : i + BOX * BOXES].tobytes() for i in range(0, len(axes), BOX * BOXES)]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["points"])

    return points.select(*AXES).repartitionByRange(*AXES).mapInArrow(run, "points binary")


def _box_tools() -> tuple[Callable, Callable, Callable]:
    """Functions that travel to the workers with a task: these need not find this package."""

    def nearest(axes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The nearest of the centres, the first of equals, as ``_sums`` finds it."""
        apart = np.zeros((len(rows), axes.shape[1]))
        for i, axis in enumerate(axes):
            away = rows[:, i, None] - axis
            away *= away
            apart += away
        return apart.argmin(axis=0)

    def inside(low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The centre that is nearest to every point of a box, or -1.

        How much nearer a point is to one centre than to another grows evenly along each side, so it is least at a corner. What rounding can
        change counts as not settled.
        """
        at = nearest((low + high).T / 2, rows)
        own = rows[at]
        settled = np.ones(len(at), bool)
        for j, other in enumerate(rows):
            corner = np.where(other > own, high, low)
            far, near = ((corner - other) ** 2).sum(axis=1), ((corner - own) ** 2).sum(axis=1)
            settled &= (at == j) | (far - near > 1e-9 * (1 + far + near))
        return np.where(settled, at, -1)

    def exact_sums(at: np.ndarray, parts: np.ndarray, k: int) -> np.ndarray:
        """Whole sums of each column of ``parts`` per place, as integers: the halves of the numbers are summed as doubles that hold them."""
        sums = []
        for column in parts.T:
            upper = column >> 26
            halves = [np.bincount(at, half.astype(float), k) for half in (upper, column - (upper << 26))]
            sums.append((halves[0].astype(np.int64) << 26) + halves[1].astype(np.int64))
        return np.stack(sums)

    return nearest, inside, exact_sums


def _moved(boxes: DataFrame, centres: dict[int, np.ndarray]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(start, centre) to its number of points and their summed coordinates, the same as those of ``_sums``."""
    nearest, inside, exact_sums = _box_tools()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[list[int]]] = {s: [[0] * (len(AXES) + 1) for _ in rows] for s, rows in centres.items()}
        for batch in batches:
            for data in batch.column(0).to_pylist():
                points = np.frombuffer(data, float).reshape(-1, len(AXES))
                whole = np.rint(points * UNIT).astype(np.int64)
                first = np.arange(0, len(points), BOX)
                count = np.diff(np.append(first, len(points)))
                low, high = np.minimum.reduceat(points, first), np.maximum.reduceat(points, first)
                added = np.add.reduceat(whole, first)
                for start, rows in centres.items():
                    k, at = len(rows), inside(low, high, rows)
                    closed = at >= 0
                    n = np.bincount(at[closed], count[closed], k).astype(np.int64)
                    sums = exact_sums(at[closed], added[closed], k)
                    if not closed.all():
                        opened = np.repeat(~closed, count)
                        one = nearest(np.ascontiguousarray(points[opened].T), rows)
                        n += np.bincount(one, minlength=k)
                        sums += exact_sums(one, whole[opened], k)
                    for mine, *numbers in zip(total[start], n.tolist(), *sums.tolist()):
                        for i, number in enumerate(numbers):
                            mine[i] += number
        found = [(start, at, *map(Decimal, numbers)) for start, rows in total.items() for at, numbers in enumerate(rows) if numbers[0]]
        kinds = [pa.int32(), pa.int32(), *[pa.decimal128(38, 0)] * (len(AXES) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(kinds)], names=["start", "at", "n", *AXES])

    schema = "start int, at int, " + ", ".join(f"{c} decimal(38,0)" for c in ["n", *AXES])
    sums = boxes.mapInArrow(run, schema).groupBy("start", "at").agg(*[F.sum(c).alias(c) for c in ["n", *AXES]])
    return {(r["start"], r["at"]): (int(r["n"]), [int(r[a]) for a in AXES]) for r in sums.collect()}


def _whole(value: Column) -> Column:
    """Exact sum, whatever the order of rows."""
    return F.sum(F.rint(value * UNIT).cast("decimal(20,0)"))


def _likely(points: DataFrame, centres: dict[int, np.ndarray], wanted: list[int], step: int) -> DataFrame:
    """(CustomerID, coordinates, start, d, wanted): from each task and start the points that may be drawn, with the squared distance to the
    nearest centre. A few more than ``wanted`` are kept, so that what a last digit decides is left to the caller, who ranks them."""
    mask, spare = (1 << 64) - 1, 8
    primes = [0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5]
    salts = {start: (start + 1000 * step + SEED) * primes[0] & mask for start in centres}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, ...]] = {}
        p1, p2, p3, p5 = map(np.uint64, primes)
        for batch in batches:
            hashed, ids = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            whole = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]).astype(float)
            for low in range(0, whole.shape[1], 1 << 12):
                axes, seed = whole[:, low : low + (1 << 12)], hashed[low : low + (1 << 12)].view(np.uint64)
                for start, rows in centres.items():
                    near = np.full(axes.shape[1], np.inf)
                    for row in rows:
                        apart = np.zeros(axes.shape[1])
                        for i, axis in enumerate(axes):
                            away = row[i] - axis
                            apart += away * away
                        np.minimum(near, apart, out=near)
                    h = (seed + p5 + np.uint64(4)) ^ np.uint64(salts[start])  # what xxhash64 makes of a further whole number
                    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * p2 + p3
                    h = (h ^ (h >> np.uint64(33))) * p2
                    h = (h ^ (h >> np.uint64(29))) * p3
                    h ^= h >> np.uint64(32)
                    u = ((h >> np.uint64(11)).astype(float) + 1) / float(2**53 + 1)
                    some = np.flatnonzero(near > 0)
                    key = -np.log(u[some]) / near[some]
                    if start in kept:
                        key, place = np.append(kept[start][0], key), np.append(np.full(len(kept[start][0]), -1), some)
                    else:
                        place = some
                    most = wanted[start] + spare
                    best = np.argpartition(key, most)[:most] if len(key) > most else np.arange(len(key))
                    old, new = best[place[best] < 0], place[best[place[best] >= 0]]
                    held = (key[best[place[best] < 0]], *(x[old] for x in kept[start][1:])) if start in kept else None
                    named = np.array([*ids.take(pa.array(low + new)).to_pylist(), 0], object)[:-1]
                    fresh = (key[best[place[best] >= 0]], named, near[new], *(axis[new] for axis in axes))
                    kept[start] = fresh if held is None else tuple(np.append(x, y) for x, y in zip(held, fresh))
        for start, (_, some, near, *axes) in kept.items():
            columns = [pa.array(some, pa.int64()), *[pa.array(a, pa.float64()) for a in axes], pa.array(np.full(len(some), start), pa.int32())]
            columns += [pa.array(near, pa.float64()), pa.array(np.full(len(some), wanted[start]), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["CustomerID", *AXES, "start", "d", "wanted"])

    schema = "CustomerID long, " + ", ".join(f"{a} double" for a in AXES) + ", start int, d double, wanted int"
    return points.select(F.xxhash64("CustomerID").alias("hashed"), F.col("CustomerID").cast("long"), *AXES).mapInArrow(run, schema)


def _seeds(points: DataFrame, runs: list[tuple[int, int]]) -> dict[int, np.ndarray]:
    """First centres of each run (k, seed)."""
    first = points.select("CustomerID", *AXES, F.explode(F.array(*[F.lit(s) for s in sorted({s for _, s in runs})])).alias("seed"))
    order = Window.partitionBy("seed").orderBy(F.xxhash64("CustomerID", "seed"), "CustomerID")
    found = first.withColumn("n", F.row_number().over(order)).where("n = 1").collect()
    taken = {s: [[r[a] for a in AXES] for r in found if r["seed"] == seed] for s, (_, seed) in enumerate(runs)}
    if not found:
        return {}
    wanted = [OVERSAMPLE * k for k, _ in runs]
    for step in range(SEED_ROUNDS):
        # the smallest -ln(u) / d are a draw without replacement, with chances in proportion to d
        away = _likely(points, {s: np.array(c) for s, c in taken.items()}, wanted, step)
        u = (F.shiftrightunsigned(F.xxhash64("CustomerID", F.col("start") + 1000 * step + SEED), 11) + 1) / float(2**53 + 1)
        order = Window.partitionBy("start").orderBy(-F.ln(u) / F.col("d"), "CustomerID")
        drawn = away.withColumn("n", F.row_number().over(order)).where("n <= wanted")
        for r in drawn.orderBy("start", "n").collect():  # OVERSAMPLE * k per start
            taken[r["start"]].append([r[a] for a in AXES])
    held = {s: np.unique(np.array(c), axis=0) for s, c in taken.items()}
    weights = {place: n for place, (n, _, _) in _sums(points, held).items()}
    return {s: _spread(held[s], np.array([weights.get((s, i), 0) for i in range(len(held[s]))], float), k, seed) for s, (k, seed) in enumerate(runs)}


def _spread(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of the candidates, each drawn in proportion to its weight times the squared distance from those drawn before."""
    rng = np.random.default_rng(seed)
    chance, chosen = weights.copy(), []
    while len(chosen) < min(k, len(candidates)) and chance.sum() > 0:
        chosen.append(int(np.searchsorted(np.cumsum(chance) / chance.sum(), rng.random(), side="right")))
        apart = ((candidates[:, None] - candidates[chosen][None]) ** 2).sum(axis=2).min(axis=1)
        chance = weights * apart
    return candidates[chosen]


def _settled(boxes: DataFrame, centres: dict[int, np.ndarray], tolerance: float, max_iter: int) -> dict[int, np.ndarray]:
    """Centres moved to the means of their points until each start's moves stay within the tolerance, one pass per step."""
    centres, moving = dict(centres), set(centres)
    for _ in range(max_iter):
        if not moving:
            break
        moved = {s: centres[s].copy() for s in moving}
        for (s, at), (n, axes) in _moved(boxes, {s: centres[s] for s in moving}).items():
            moved[s][at] = [float(a) / UNIT / n for a in axes]
        for s, rows in moved.items():
            if ((rows - centres[s]) ** 2).sum() <= tolerance:
                moving.discard(s)
            centres[s] = rows
    return centres


def _inertia(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, float]:
    if not centres:
        return {}
    total: dict[int, int] = {}
    for (start, _), (_, _, d) in _sums(points, centres).items():
        total[start] = total.get(start, 0) + d
    return {start: float(d) / UNIT for start, d in total.items()}


def fit(points: DataFrame, runs: list[tuple[int, int]], max_iter: int) -> list[Clustering]:
    """The best start of each number of clusters among ``runs`` (k, seed); fewer centres where points are fewer.

    Starts are compared once they move little; the best of each k goes on until its centres stay. The driver holds the
    centres alone. A centre that loses all its points stays where it is.
    """
    boxes = materialise(_boxes(points), "boxes")
    rough = _settled(boxes, _seeds(points, runs), TOLERANCE, max_iter)
    cost = _inertia(points, rough)
    best: dict[int, int] = {}
    for s, (k, _) in enumerate(runs):
        if s in cost and (k not in best or cost[s] < cost[best[k]]):
            best[k] = s
    final = _settled(boxes, {k: rough[s] for k, s in best.items()}, 0.0, max_iter)
    final = {k: rows[np.lexsort(rows.T[::-1])] for k, rows in final.items()}
    cost = _inertia(points, final)
    return [Clustering(k, rows, cost[k]) for k, rows in final.items()]


def _assigned(points: DataFrame, found: list[Clustering]) -> DataFrame:
    """CustomerID, coordinates and Cluster: the place of the nearest centre."""
    near = _against(points, {0: found[0].centres}) if found else points.withColumn("at", F.lit(0))
    return near.withColumn("Cluster", F.col("at").cast("int")).select("CustomerID", *AXES, "Cluster")


def kmeans_clusters(metrics: DataFrame, k: int = 4, starts: int = STARTS, max_iter: int = 300) -> DataFrame:
    """Cluster number per customer from the best of several starts. Clusters are numbered by the coordinates of their centres."""
    points = materialise(_points(metrics), "rfm-scaled")
    found = fit(points, [(k, SEED + i) for i in range(starts)], max_iter)
    return materialise(_assigned(points, found).select("CustomerID", "Cluster"), "clusters")


def kmeans_elbow(
    metrics: DataFrame,
    ks: Iterable[int] = range(2, 9),
    starts: int = STARTS,
    max_iter: int = 300,
) -> DataFrame:
    """Inertia and silhouette (squared Euclidean) for several numbers of clusters."""
    points = materialise(_points(metrics), "rfm-scaled")
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="Cluster")
    assemble = VectorAssembler(inputCols=AXES, outputCol="features")
    rows = []
    for c in fit(points, [(k, SEED + i) for k in ks for i in range(starts)], max_iter):
        rows.append((c.k, c.inertia, float(evaluator.evaluate(assemble.transform(_assigned(points, [c]))))))
    return metrics.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def clustering_check(metrics: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row: customers, clusters, misplaced (customers nearer to another cluster's mean) and whether inertia is that of the means.

    A clustering that K-Means can improve has misplaced customers. Nearer means by over a millionth of a deviation.
    """
    placed = materialise(_points(metrics).join(clusters, "CustomerID"), "clusters-placed")
    means = placed.groupBy("Cluster").agg(F.count(F.lit(1)).alias("n"), *[(_whole(F.col(a)).cast("double") / UNIT / F.count(F.lit(1))).alias(a) for a in AXES])
    listed = means.orderBy("Cluster").collect()  # a row per cluster
    if not listed:
        return placed.agg(F.count(F.lit(1)).alias("customers"), F.count(F.lit(1)).alias("clusters"), F.count(F.lit(1)).alias("misplaced"))
    near = _against(placed, {0: np.array([[r[a] for a in AXES] for r in listed])}).select("CustomerID", "d")
    own = {f"own_{i}": F.expr("CASE Cluster " + " ".join(f"WHEN {r['Cluster']} THEN {r[a]!r}D" for r in listed) + " END") for i, a in enumerate(AXES)}
    apart = placed.withColumns(own).withColumn("own", sum((F.col(f"own_{i}") - F.col(a)) ** 2 for i, a in enumerate(AXES)))
    both = apart.select("CustomerID", "own").join(near, "CustomerID")
    worse = F.sqrt("own") > F.sqrt("d") + 1e-6
    return both.agg(F.count(F.lit(1)).alias("customers"), F.lit(len(listed)).cast("long").alias("clusters"), F.count_if(worse).alias("misplaced"))


def cluster_profile(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("Cluster").agg(*[round_even(exact_mean(F.col(m)), 2).alias(m) for m in METRICS])


def label_clusters(profile: DataFrame) -> DataFrame:
    """Label each cluster by its mean recency and spend against the medians over the clusters."""
    middle = profile.agg(
        F.struct(F.percentile("Recency", 0.5).alias("recency"), F.percentile("Monetary", 0.5).alias("money")).alias("m")
    ).scalar()
    recent = F.col("Recency") < F.col("_m.recency")
    rich = F.col("Monetary") > F.col("_m.money")
    return (
        profile.withColumn("_m", middle)
        .withColumn(
            "Cluster_Label",
            F.when(recent & rich, "Champions")
            .when(recent, "Loyal Customers")
            .when(rich, "At Risk")
            .otherwise("Lost Customers"),
        )
        .drop("_m")
    )


def kmeans_segments(segments: DataFrame, **options) -> DataFrame:
    """RFM segments with cluster number and cluster label."""
    clustered = segments.join(kmeans_clusters(segments.select("CustomerID", *METRICS), **options), "CustomerID")
    return with_labels(clustered).select(*segments.columns, "Cluster", "Cluster_Label")


def with_labels(clustered: DataFrame) -> DataFrame:
    """Customers with the label of their cluster."""
    # one row per cluster
    labels = F.broadcast(label_clusters(cluster_profile(clustered)).select("Cluster", "Cluster_Label"))
    return clustered.join(labels, "Cluster")
