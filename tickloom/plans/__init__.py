"""Composite queries and the query catalogue with its DuckDB twins."""
