"""Registered queries: each key is a Spark plan plus its DuckDB oracle."""
