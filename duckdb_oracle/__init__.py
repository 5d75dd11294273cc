"""DuckDB oracle SQL for the query catalog (used by the correctness gate)."""

from duckdb_oracle.queries import oracle_queries

__all__ = ["oracle_queries"]
