"""The screening queries and their SQL."""

from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
