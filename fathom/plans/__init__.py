"""The analytical queries, registered by key with their SQL oracle."""

from fathom.plans.registry import REGISTRY, oracle_sql, spark_queries

__all__ = ["REGISTRY", "oracle_sql", "spark_queries"]
