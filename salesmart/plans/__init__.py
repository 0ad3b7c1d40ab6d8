"""Composed jobs: the ETL run, the query registry and the DuckDB oracle SQL."""
