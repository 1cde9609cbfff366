"""Registered queries: name → (spark, sf_dir) → DataFrame, plus DuckDB oracles."""

from changeflow.plans.registry import queries, oracle_sql, flagship

__all__ = ["queries", "oracle_sql", "flagship"]
