"""Declared input schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from basketwise.functions.numeric import nan_to_null

RETAIL_RAW = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

REVIEWS_RAW = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("ProductId", T.StringType()),
        T.StructField("UserId", T.StringType()),
        T.StructField("Score", T.IntegerType()),
        T.StructField("Summary", T.StringType()),
        T.StructField("Text", T.StringType()),
        T.StructField("Time", T.LongType()),
    ]
)

LEXICON = T.StructType([T.StructField("token", T.StringType()), T.StructField("valence", T.DoubleType())])
BOOSTERS = T.StructType([T.StructField("token", T.StringType()), T.StructField("weight", T.DoubleType())])
NEGATIONS = T.StructType([T.StructField("token", T.StringType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check that every declared column is there, cast it, and turn NaN into null.

    Further columns (an ordinal, for instance) pass through.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    declared = []
    for field in schema:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            value = nan_to_null(value)
        declared.append(value.alias(field.name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.names]
    return df.select(*declared, *extra)
