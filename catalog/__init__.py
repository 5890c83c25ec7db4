"""Registered queries over the test tables, each with the SQL that checks it."""

from . import file_queries, search_queries, table_queries  # noqa: F401
from .core import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
