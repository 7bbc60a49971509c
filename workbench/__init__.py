"""Binds the library to the given Parquet tables: inputs, queries and their DuckDB equivalents."""
