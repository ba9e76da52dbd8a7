"""All registered queries with their SQL."""

from . import queries, state_queries
from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "queries", "state_queries"]
