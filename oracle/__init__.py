"""DuckDB statements that recompute the registered queries from the same Parquet tables."""
