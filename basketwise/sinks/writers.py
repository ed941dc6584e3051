"""Table writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, *partitions: str) -> None:
    """Overwrite a table; ``partitions`` name the columns that become folders."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Add rows to a table, as for the metrics of another run."""
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts, each with the header; quotes inside cells are doubled."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def export_columns(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Projection for an export; ``renames`` maps old to new names."""
    names = renames or {}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in columns])


def clean_names(df: DataFrame) -> DataFrame:
    """Blanks and hyphens in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_").replace("-", "_") for c in df.columns])


def publish(
    tables: Mapping[str, DataFrame],
    spark: SparkSession,
    database: str,
    location: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Save every table in the catalog, then count the rows read back from it.

    ``fmt`` may be any table format the cluster has installed.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for name, df in tables.items():
        clean_names(df).write.mode("overwrite").format(fmt).saveAsTable(f"{database}.{name}")
    return table_counts({name: spark.table(f"{database}.{name}") for name in tables})


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables saved in a database."""
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").select(F.col("tableName").alias("table_name"))


def drop_database(spark: SparkSession, database: str) -> None:
    """Drop a database with its tables, and their files."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
