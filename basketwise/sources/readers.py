"""File and catalog readers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, types as T
from pyspark.sql import functions as F

from basketwise.sources.schemas import REVIEWS_RAW, conform

# The texts a CSV cell may hold for "missing".
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


FEW_SPLITS = 8


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-distribute a scan of a few splits that leaves cores idle; leave all others alone.

    A file with one row group cannot be split further. What is moved is bounded by ``FEW_SPLITS`` splits, 1 GB by default.
    """
    splits, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if splits < cores and splits <= FEW_SPLITS else df


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def union_parts(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """UNION ALL by column name; repeated rows stay."""
    for part in rest:
        first = first.unionByName(part)
    return first


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, header) of CSV files whose quoted cells may hold line breaks, each file read by many tasks.

    Whether a line break ends a record depends on the quotes before it: inside a cell their number is odd (a doubled quote
    counts twice). So each split counts its quotes, a running sum over a file's splits tells which of them start inside a
    cell, and then every task cuts its own lines. What the first and last record of a split lack of their text is
    put together afterwards, two pieces per split at most. Records end with a line feed, or carriage return and line feed; line breaks
    in cells stay as they are. ``header`` marks the first record of a file. Quotes stand around cells only, or doubled inside them.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    splits = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    splits = splits.withColumn("first", F.row_number().over(Window.partitionBy("file").orderBy("start")) == 1)
    placed = lines.join(splits.drop("quotes"), ["file", "start"]).sortWithinPartitions("file", "start", "line")
    cut = placed.select("file", "start", "inside", "first", "value").mapInArrow(_record_cutter(), "file string, start long, kind string, record string")

    whole = cut.where("kind IN ('whole', 'header')").select("file", "record", (F.col("kind") == "header").alias("header"))
    # pieces of one record follow each other: it opens in one split, may fill others, and closes in a later one
    pieces = cut.where("kind NOT IN ('whole', 'header')")
    opened = F.sum(F.when(F.col("kind").isin("open", "header-open"), 1).otherwise(0)).over(Window.partitionBy("file").orderBy("start", F.col("kind") != "close"))
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "record")))
    joined = pieces.withColumn("n", opened).groupBy("file", "n").agg(parts.alias("parts"), F.max(F.col("kind") == "header-open").alias("header"))
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["record"]), "\n"), "\r$", "")
    return whole.unionByName(joined.select("file", text.alias("record"), "header"))


def _record_cutter():
    """Cuts the lines of each split into records, and the pieces at its two ends that belong to other splits' records.

    A nested function, which reaches the workers without this package being installed there.
    """
    names = ["file", "start", "kind", "record"]

    def batch_of(rows: list[tuple[str, int, str, str]]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str, str]] = []
        split, held, odd, kind = None, [], False, "whole"

        def finish() -> None:
            # what is left at the end of a split goes on in the next one
            if held:
                out.append((*split, {"close": "fill", "header": "header-open"}.get(kind, "open"), "\n".join(held)))

        for batch in batches:
            for file, start, inside, first, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != split:
                    finish()
                    split, held, odd = (file, start), [], inside
                    kind = "close" if inside else "header" if first else "whole"
                held.append(value)
                odd ^= value.count('"') % 2 == 1
                if not odd:
                    record, held = "\n".join(held).removesuffix("\r"), []
                    if record or kind == "close":  # blank lines are no records
                        out.append((*split, kind, record))
                        kind = "whole"
            if out:
                yield batch_of(out)
                out.clear()
        finish()
        if out:
            yield batch_of(out)

    return run


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, doubled quotes inside quoted cells, and line breaks inside quotes.

    All cells are read as text, so that the usual texts for "missing" become null before casting. A file whose header differs
    from the schema, or a record with other than its number of cells, is an error.
    """
    names = [f.name for f in schema]
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    cells = F.from_csv("record", text.simpleString()[len("struct<") : -1].replace(":", " "), options)
    parsed = csv_records(spark, path).select("file", "header", cells.alias("cells"))
    given = F.array(*[F.col(f"cells.c{i}") for i in range(len(names))])
    wrong = F.col("header") & (given != F.array(*map(F.lit, names)))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("CSV header differs from the schema in "), "file"))).otherwise(F.lit(True))
    rows = parsed.where(checked.cast("boolean") & ~F.col("header"))
    missing = lambda c: F.when(c.isin(MISSING_TEXTS), None).otherwise(c)
    return conform(rows.select(*[missing(F.col(f"cells.c{i}")).alias(n) for i, n in enumerate(names)]), schema)


def read_reviews_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, REVIEWS_RAW)
