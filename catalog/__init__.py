"""Registered queries, each beside the SQL that states its result."""

from catalog.registry import QUERIES, SQL
from catalog import cells, cleaning, rates, replies, resuming, tables, translating  # noqa: F401

__all__ = ["QUERIES", "SQL"]
