"""Parquet, CSV and catalog sinks."""
