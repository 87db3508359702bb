"""Importing this module registers all queries."""

from ledgerlens.queries import invariant_queries, model_queries, table_queries, text_queries, vector_queries  # noqa: F401
from ledgerlens.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
