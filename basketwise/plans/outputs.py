"""A run of the whole pipeline that leaves its tables and exports in a folder.

Every run writes to a folder of its own and becomes current as a whole, by one row that is written last. So readers see the tables of
one run, whenever another breaks off, and a run that is started again under its name takes up what it had finished.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketwise.operators import cluster, master, sentiment, survival
from basketwise.plans.stages import Lifecycle
from basketwise.sinks import writers

# Columns of the exports in order, and renamed ones.
MASTER_EXPORT = [
    "CustomerID", "Recency", "Frequency", "Monetary", "RFM_Score", "RFM_Segment", "Cluster_Label", "duration",
    "churned", "total_orders", "avg_order_value", "days_since_last", "segment",
]
RFM_EXPORT = ["CustomerID", "Recency", "Frequency", "Monetary", "RFM_Score", "RFM_Segment", "Cluster_Label"]
SURVIVAL_EXPORT = [
    "Customer ID", "duration", "churned", "total_orders", "total_spend", "avg_order_value", "days_since_last",
    "segment", "purchase_frequency",
]
AT_RISK_EXPORT = [
    "Customer ID", "days_since_last", "total_orders", "total_spend", "avg_order_value", "risk_score", "segment",
]
ID_RENAME = {"Customer ID": "CustomerID"}


_ENTRY = "name string, row_count long, checksum long, schema string"
_COMMIT = "number long, version string, tables array<struct<name: string, row_count: long, checksum: long>>"


def _stored(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame | None:
    """A table, or None where there is none yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def checksum(df: DataFrame) -> tuple[int, int]:
    """Number of rows, and an exclusive or of their hashes that does not depend on their order."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x")).first()
    return row["n"], row["x"] or 0


class Run:
    """The tables of one run, each stored with an entry (rows, checksum, schema) in the run's manifest once it is complete."""

    def __init__(self, spark: SparkSession, target: str, version: str) -> None:
        self.spark, self.target, self.version = spark, target.rstrip("/"), version
        self.folder = f"{self.target}/runs/{version}"
        listed = _stored(spark, f"{self.folder}/_manifest", _ENTRY)
        self.entries = {} if listed is None else {r["name"]: tuple(r)[1:] for r in listed.collect()}

    def _finish(self, name: str, entry: tuple[int, int, str]) -> None:
        self.spark.createDataFrame([(name, *entry)], _ENTRY).coalesce(1).write.mode("append").parquet(f"{self.folder}/_manifest")
        self.entries[name] = entry

    def table(self, name: str, make: Callable[[], DataFrame], *partitions: str) -> DataFrame:
        """The stored table; made and written unless the manifest has it and its rows and checksum still hold."""
        path = f"{self.folder}/{name}"
        if name in self.entries:
            *entry, schema = self.entries[name]
            known = _stored(self.spark, path, StructType.fromJson(json.loads(schema)))
            if known is not None and list(checksum(known)) == entry:
                return known
        df = make()
        writers.write_parquet(df, path, *partitions)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._finish(name, (*checksum(stored), df.schema.json()))
        return stored

    def export(self, name: str, make: Callable[[], DataFrame]) -> None:
        if f"exports/{name}" not in self.entries:
            df = make()
            writers.write_csv(df, f"{self.folder}/exports/{name}")
            self._finish(f"exports/{name}", (df.count(), 0, df.schema.json()))

    def commit(self) -> None:
        """Makes this run the current one: one row in one file, which appears when it is complete."""
        done = _stored(self.spark, f"{self.target}/_commits", _COMMIT)
        last = done.agg(F.max("number")).first()[0] if done is not None else None
        rows = [((last or 0) + 1, self.version, [(n, *e[:2]) for n, e in sorted(self.entries.items())])]
        self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("append").parquet(f"{self.target}/_commits")


def current(spark: SparkSession, target: str) -> str | None:
    """Folder of the last run that was completed under ``target``, or None."""
    target = target.rstrip("/")
    done = _stored(spark, f"{target}/_commits", _COMMIT)
    last = None if done is None else done.orderBy(F.desc("number")).select("version").first()
    return f"{target}/runs/{last['version']}" if last else None


def read_current(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table of the last completed run."""
    folder = current(spark, target)
    if folder is None:
        raise FileNotFoundError(f"no completed run under {target}")
    return spark.read.parquet(f"{folder}/{name}")


def run(lc: Lifecycle, target: str, fixed_clusters: DataFrame | None = None, version: str | None = None) -> dict[str, DataFrame]:
    """Write the ten tables as Parquet and the five exports as CSV under ``target``; returns the tables, read back.

    Later outputs are made from the stored ones before them. The clusters are K-Means clusters unless given
    (``fixed_clusters``: the RFM segments with a Cluster column). A run of the same ``version`` that broke off is taken up: tables of its
    manifest are read, not made again. The run is what ``read_current`` reads once all is written.
    """
    made = Run(lc.spark, target, version or uuid.uuid4().hex)
    stored: dict[str, DataFrame] = {}

    def store(name: str, make: Callable[[], DataFrame], *partitions: str) -> DataFrame:
        stored[name] = made.table(name, make, *partitions)
        return stored[name]

    lc.history = store("retail_clean", lambda: lc.retail.drop("ordinal"))
    store("reviews_clean", lambda: lc.reviews.drop("ordinal"))
    scored = store("reviews_with_sentiment", lambda: lc.scored_reviews.drop("ordinal"), "YearMonth")
    products = store("product_sentiment", lambda: sentiment.product_sentiment(scored))
    store("customer_similarity", lambda: lc.stored_neighbours)
    store("recommendations", lambda: lc.recommendations)
    lives = store("survival_data", lambda: lc.survival)
    at_risk = store("at_risk_customers", lambda: survival.by_risk(survival.at_risk_customers(lives)))
    segments = store("rfm_segments", lambda: lc.kmeans_segments if fixed_clusters is None else cluster.with_labels(fixed_clusters))
    customers = store("master_customers", lambda: master.master_customers(segments, lives, lc.rec_summary))

    made.export("master_customers", lambda: writers.export_columns(customers, MASTER_EXPORT))
    made.export("rfm_segments", lambda: writers.export_columns(segments, RFM_EXPORT))
    made.export("survival_data", lambda: writers.export_columns(lives, SURVIVAL_EXPORT, ID_RENAME))
    made.export("at_risk_customers", lambda: writers.export_columns(survival.by_risk(at_risk), AT_RISK_EXPORT, ID_RENAME))
    made.export("product_sentiment", lambda: products)
    made.commit()
    return stored


def counted(stored: dict[str, DataFrame], lc: Lifecycle, target: str) -> DataFrame:
    """Rows of each stored table and of each export of the current run, read back."""
    folder = current(lc.spark, target)
    exports = {
        f"export {name}": lc.spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{folder}/exports/{name}")
        for name in ("master_customers", "rfm_segments", "survival_data", "at_risk_customers", "product_sentiment")
    }
    return writers.table_counts(stored | exports).withColumn("row_count", F.col("row_count").cast("long"))
