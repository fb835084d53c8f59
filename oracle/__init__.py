from .sql import oracle_queries

__all__ = ["oracle_queries"]
