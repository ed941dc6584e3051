"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwise.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (u, v); the component is the smallest id that can be reached.

    Star contraction: in turn, larger neighbours of a node and smaller ones are linked to the smallest neighbour, until
    nothing changes. The rounds grow with the logarithm of the longest chain. Each is written as a table, and only a
    count and a checksum reach the driver. Links to itself or to null are ignored; repeated ones count once.
    """
    edges = links.select(F.greatest("u", "v").alias("high"), F.least("u", "v").alias("low")).where("u <> v").distinct()
    before = None
    while True:
        edges = materialise(edges, "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("high").alias("id"), F.col("low").alias("component"))
        before = now
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.least(F.min("low"), F.col("high")).alias("least"))
        large = both.join(least, "high").where("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(least, "high")
        edges = (
            small.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
            .unionByName(least.select("high", F.col("least").alias("low")))
            .distinct()
        )
