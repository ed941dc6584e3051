import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketwise.operators import cluster, master, rfm
from basketwise.sinks import writers


def _blobs(spark):
    rng = np.random.default_rng(0)
    centres = [(5, 50, 9000), (5, 20, 100), (400, 20, 9000), (400, 2, 100)]
    rows = [
        (i, float(r + rng.normal()), float(f + rng.normal() / 10), float(m + rng.normal()))
        for i, (r, f, m) in enumerate(centres * 15)
    ]
    return spark.createDataFrame(rows, "CustomerID long, Recency double, Frequency double, Monetary double")


def test_blobs_are_found_and_labelled(spark):
    labelled = cluster.kmeans_segments(_blobs(spark), starts=4).toPandas()
    labels = labelled.groupby(labelled.CustomerID % 4)["Cluster_Label"].agg(lambda s: "|".join(sorted(set(s))))
    assert labels.tolist() == ["Champions", "Loyal Customers", "At Risk", "Lost Customers"]
    assert labelled.groupby(labelled.CustomerID % 4)["Cluster"].nunique().eq(1).all()


def test_partitions_do_not_change_clusters(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.integers(1, 300)), float(rng.integers(1, 40)), float(rng.gamma(2, 100))) for i in range(400)]
    df = spark.createDataFrame(rows, "CustomerID long, Recency double, Frequency double, Monetary double")
    got = [sorted(map(tuple, cluster.kmeans_clusters(df.repartition(n), starts=3).collect())) for n in (1, 7)]
    assert got[0] == got[1] and {c for _, c in got[0]} == {0, 1, 2, 3}
    check = cluster.clustering_check(df, spark.createDataFrame(got[0], "CustomerID long, Cluster int")).first()
    assert (check["customers"], check["clusters"]) == (400, 4) and check["misplaced"] == 0
    moved = [(i, (c + 1) % 4 if i < 5 else c) for i, c in got[0]]
    assert cluster.clustering_check(df, spark.createDataFrame(moved, "CustomerID long, Cluster int")).first()["misplaced"] >= 5


def test_inertia_is_near_the_best_of_many_starts(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.3, (60, 3)) for c in ((0, 0, 0), (4, 0, 0), (0, 4, 1), (3, 3, 3), (6, 6, 0))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "CustomerID long, Recency double, Frequency double, Monetary double")
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    best = np.inf
    for _ in range(30):
        centres = z[rng.choice(len(z), 5, replace=False)]
        for _ in range(50):
            near = ((z[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
            centres = np.stack([z[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(5)])
        best = min(best, ((z - centres[near]) ** 2).sum())
    row = cluster.kmeans_elbow(df, ks=[5], starts=4).first()
    assert row["inertia"] == pytest.approx(best, rel=1e-3)


def test_fewer_customers_than_clusters_and_none(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (2, 5.0, 1.0, 1.0), (3, 5.0, 1.0, 1.0)], "CustomerID long, Recency double, Frequency double, Monetary double")
    got = {r["CustomerID"]: r["Cluster"] for r in cluster.kmeans_clusters(df, starts=2).collect()}
    assert got[2] == got[3] != got[1]
    assert cluster.kmeans_clusters(df.limit(0), starts=2).count() == 0


def test_elbow_falls_until_the_true_number(spark):
    rows = cluster.kmeans_elbow(_blobs(spark), ks=[2, 4], starts=4).orderBy("k").collect()
    assert rows[0]["inertia"] > rows[1]["inertia"]
    assert rows[1]["silhouette"] > 0.9 > rows[0]["silhouette"]


def test_labels_need_a_strictly_better_profile(spark):
    rows = [(0, 10.0, 1.0, 500.0), (1, 10.0, 1.0, 400.0), (2, 10.0, 1.0, 300.0), (3, 90.0, 1.0, 900.0)]
    profile = spark.createDataFrame(rows, "Cluster int, Recency double, Frequency double, Monetary double")
    got = {r["Cluster"]: r["Cluster_Label"] for r in cluster.label_clusters(profile).collect()}
    assert got == {0: "At Risk", 1: "Lost Customers", 2: "Lost Customers", 3: "At Risk"}


def test_summary_percentages_come_from_rounded_numbers(spark):
    rows = [(i, 1, 1, 10.0, 9, "A" if i < 3 else "B", 30, int(i == 0), 1, 5.0, 2, "x", 1.0, "p") for i in range(6)]
    df = spark.createDataFrame(
        rows,
        "CustomerID long, Recency long, Frequency long, Monetary double, RFM_Score int, RFM_Segment string, "
        "duration long, churned int, total_orders long, avg_order_value double, days_since_last long, segment string, "
        "avg_rec_score double, top_rec_product string",
    )
    got = {r["RFM_Segment"]: r for r in master.segment_summary(df, "RFM_Segment").collect()}
    assert got["A"]["churn_rate"] == 0.33 and got["A"]["churn_rate_pct"] == 33.0
    assert got["A"]["revenue_share_pct"] == 50.0
    assert sum(r["count"] for r in rfm.value_shares(df, "RFM_Segment").collect()) == 6
    assert master.business_metrics(df, "RFM_Segment").first()["champions_revenue"] is None


@pytest.mark.parametrize(("digits", "revenue"), [(0, 11.0), (2, 11.4)])
def test_dashboard_orders_by_revenue(spark, digits, revenue):
    rows = [("a", 10.4, 1), ("b", 20.0, 0), ("a", 1.0, 0)]
    df = spark.createDataFrame(rows, "RFM_Segment string, Monetary double, churned int")
    got = [tuple(r) for r in master.segment_revenue(df, digits).collect()]
    assert got == [("b", 1, 20.0, 0.0), ("a", 2, revenue, 50.0)]


def test_bands_and_top_descriptions(spark):
    products = spark.createDataFrame([(0.5,), (0.49,), (0.0,), (-0.05,), (-0.06,), (None,)], "avg_sentiment double")
    got = [tuple(r) for r in master.sentiment_bands(products).collect()]
    assert got == [("Negative", 2), ("Neutral", 2), ("Positive", 1), ("Very Positive", 1)]
    lists = spark.createDataFrame([("x", 1.4), ("x", 1.2), ("y", 3.0), ("z", 0.1)], "Description string, Score double")
    assert [tuple(r) for r in master.top_recommended(lists, 2).collect()] == [("x", 3.0), ("y", 3.0)]


def test_metrics_of_runs_pile_up_in_one_table(spark, tmp_path):
    values = spark.createDataFrame([(3, 0.5)], "customers long, rate double")
    for run in ("a", "b"):
        writers.append_parquet(master.run_metrics(values, run, {"model": "x", "k": 4}), str(tmp_path / "metrics"))
    rows = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "metrics")).where("run = 'a'").collect())
    assert rows == [
        ("a", "metric", "customers", 3.0, None),
        ("a", "metric", "rate", 0.5, None),
        ("a", "parameter", "k", 4.0, None),
        ("a", "parameter", "model", None, "x"),
    ]
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 8


def test_sums_leave_a_row_per_task_and_centre_and_equal_the_rows_groups(spark):
    rng = np.random.default_rng(6)
    rows = [(i, *map(float, rng.normal(0, 2, 3))) for i in range(500)]
    points = spark.createDataFrame(rows, ["CustomerID", *cluster.AXES]).repartition(3)
    centres = {0: rng.normal(0, 2, (4, 3)), 7: np.array([[0.0, 0.0, 0.0], [0.0, 0.0, 0.0], [1.0, 1.0, 1.0]])}
    near = cluster._against(points, centres).toPandas()
    near[[*cluster.AXES, "d"]] = np.rint(near[[*cluster.AXES, "d"]] * cluster.UNIT).astype("int64")
    expected = {place: (len(g), [int(g[a].sum()) for a in cluster.AXES], int(g.d.sum())) for place, g in near.groupby(["start", "at"])}
    assert cluster._sums(points, centres) == expected


def test_boxes_give_the_sums_of_all_points(spark):
    """Ties, equal centres, far outliers and nearly equal points; most boxes are added as a whole."""
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, xyz)) for i, xyz in enumerate(np.round(rng.standard_normal((6000, 3)) ** 3, 2))]
    rows += [(10**6 + i, 0.5, 0.5, 0.5) for i in range(700)] + [(-1, 9e5, -9e5, 1e4), (-2, -9e5, 3.0, 0.0)]
    points = spark.createDataFrame(rows, "CustomerID long, " + ", ".join(f"{a} double" for a in cluster.AXES)).repartition(3)
    centres = {s: np.round(rng.standard_normal((k, 3)), 1) for s, k in enumerate([1, 2, 4, 8])}
    centres[4] = np.array([[0.5, 0.5, 0.5], [0.5, 0.5, 0.5], [-0.5, 0.5, 0.5], [1.5, 0.5, 0.5]])
    boxes = cluster._boxes(points)
    assert cluster._moved(boxes, centres) == {place: (n, axes) for place, (n, axes, _) in cluster._sums(points, centres).items()}
    data = np.vstack([np.frombuffer(r["points"], float).reshape(-1, 3) for r in boxes.collect()])
    assert sorted(map(tuple, data)) == sorted(r[1:] for r in rows)
    low, high = np.array([[0.0, 0, 0], [-9, -9, -9], [0, 0, 0]]), np.array([[0.1, 0.1, 0.1], [9, 9, 9], [0.5, 0, 0]])
    assert cluster._box_tools()[1](low, high, np.array([[0.0, 0, 0], [1, 0, 0]])).tolist() == [0, -1, -1]  # the last touches the border


def test_seeds_are_drawn_as_by_ranking_every_point(spark):
    """The points that tasks leave contain the draws among all points, by hash and distance, whatever the batches."""
    rng = np.random.default_rng(7)
    rows = [(int(i), *map(float, xyz)) for i, xyz in zip(rng.integers(-(2**62), 2**62, 9000), rng.standard_normal((9000, 3)) ** 3)]
    rows += [(5, 0.0, 0.0, 0.0), (6, 0.0, 0.0, 0.0)]
    points = spark.createDataFrame(rows, "CustomerID long, " + ", ".join(f"{a} double" for a in cluster.AXES)).repartition(2)
    centres = {0: np.zeros((1, 3)), 1: rng.standard_normal((6, 3)), 2: np.array([rows[0][1:], rows[1][1:]])}
    wanted, step = [4, 8, 16], 2

    def drawn(away):
        u = (F.shiftrightunsigned(F.xxhash64("CustomerID", F.col("start") + 1000 * step + cluster.SEED), 11) + 1) / float(2**53 + 1)
        order = Window.partitionBy("start").orderBy(-F.ln(u) / F.col("d"), "CustomerID")
        ranked = away.withColumn("n", F.row_number().over(order)).where("n <= 16").orderBy("start", "n").collect()
        return [(r["start"], r["n"], r["CustomerID"], r["d"]) for r in ranked if r["n"] <= wanted[r["start"]]]

    left = cluster._likely(points, centres, wanted, step)
    assert left.count() <= points.rdd.getNumPartitions() * (sum(wanted) + 24)
    assert drawn(left) == drawn(cluster._against(points, centres).where("d > 0"))
