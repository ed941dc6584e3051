"""Runs that break off, against the tables a reader sees."""

import pytest
from pyspark.sql import functions as F

from basketwise.plans import outputs


def _make(spark, log, n, factor):
    def make():
        log.append(n)
        return spark.range(20).select(F.col("id"), (F.col("id") * factor).alias("v"))

    return make


def _write(spark, target, version, factor, stop=None):
    """Eight tables, each from the one before; breaks off before table ``stop``."""
    made, log, before = outputs.Run(spark, target, version), [], None
    for n in range(8):
        if n == stop:
            raise RuntimeError("lost driver")
        make = _make(spark, log, n, factor) if before is None else (lambda b=before, n=n: log.append(n) or b.withColumn("v", F.col("v") + 1))
        before = made.table(f"t{n}", make)
    made.export("t7", lambda: before)
    made.commit()
    return log


def _seen(spark, target):
    return [outputs.read_current(spark, target, f"t{n}").agg(F.sum("v")).first()[0] for n in range(8)]


def test_a_broken_run_is_not_seen_and_taken_up(spark, tmp_path):
    target = str(tmp_path / "tables")
    assert outputs.current(spark, target) is None
    with pytest.raises(FileNotFoundError):
        outputs.read_current(spark, target, "t0")
    assert _write(spark, target, "a", 1) == list(range(8))
    first = _seen(spark, target)
    with pytest.raises(RuntimeError, match="lost driver"):
        _write(spark, target, "b", 2, stop=5)
    assert _seen(spark, target) == first  # all eight tables of the run before
    assert _write(spark, target, "b", 2) == [5, 6, 7]  # the five finished ones are not made again
    assert _seen(spark, target) == [sum(2 * i + n for i in range(20)) for n in range(8)]
    assert outputs.current(spark, target).endswith("/runs/b")


def test_a_damaged_table_is_made_again(spark, tmp_path):
    target = str(tmp_path / "tables")
    with pytest.raises(RuntimeError):
        _write(spark, target, "a", 3, stop=4)
    spark.range(3).select("id", F.lit(0).cast("long").alias("v")).write.mode("overwrite").parquet(f"{target}/runs/a/t2")
    assert _write(spark, target, "a", 3) == [2, 4, 5, 6, 7]


def test_table_counts_make_no_clusters(spark):
    """The counted tables are those without clusters: K-Means, which nothing here reads, is not run."""
    from basketwise.plans.queries import QUERIES

    class Stages:
        def __getattr__(self, name):
            if name in ("clustered_master", "kmeans_segments"):
                raise AssertionError(f"{name} is not counted")
            return spark.range(len(name))

    got = {r["table_name"]: r["row_count"] for r in QUERIES["dash_table_counts"](Stages()).collect()}
    assert got["master_customers"] == len("master") and got["rfm_segments"] == len("rfm_segments") and len(got) == 6


def test_purchases_come_from_the_stored_lines(spark):
    """Where the clean lines are stored already, the order lines are not read and joined again."""
    from basketwise.plans.stages import Lifecycle

    lc = Lifecycle(spark, "nowhere")
    lc.history = spark.createDataFrame([(1, "A", 2), (1, "A", 3), (2, "B", 1)], "`Customer ID` long, StockCode string, Quantity int")
    assert sorted(map(tuple, lc.stored_matrix.collect())) == [(1, "A", 5), (2, "B", 1)]
