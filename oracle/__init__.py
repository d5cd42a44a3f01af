"""Independent SQL for each query, run by the checking database on the same tables."""

from oracle.sql import oracle_queries

__all__ = ["oracle_queries"]
