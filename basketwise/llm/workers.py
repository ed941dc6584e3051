"""Lets Python workers find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

from basketwise.session import prepare

_ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Sends workers the package's folder on their search path, and bounds the batches that are sent to them.

    A cluster without the package in that folder ships it with the job. Rows here hold whole texts, so a batch of the default
    10,000 rows could take much of an executor's memory; the session's two settings are lowered.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    environment = spark.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if _ROOT not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, path]))
    # reused workers give freed memory back, but arrays of a few megabytes are not fresh pages each time
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    environment.setdefault("MALLOC_TRIM_THRESHOLD_", str(8 << 20))
    environment.setdefault("MALLOC_MMAP_THRESHOLD_", str(8 << 20))
    environment.setdefault("MALLOC_ARENA_MAX", "1")
    return prepare(spark)
