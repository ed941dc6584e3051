"""Pipelines over the test tables, the query registry and the matching DuckDB SQL."""
