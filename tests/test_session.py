import glob
import tempfile
import time

from pyspark.sql import functions as F

from basketwise.session import FREED_CONF, materialise


def _shuffles():
    return set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, setting = _shuffles(), spark.conf.get(FREED_CONF, None)
    stored = materialise(rows, "counted")
    until = time.time() + 20
    while _shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffles() - before
    assert spark.conf.get(FREED_CONF, None) == setting
    assert sorted(r["count"] for r in stored.collect()) == sorted(r["count"] for r in rows.collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert _shuffles() - before  # those of the collected rows
