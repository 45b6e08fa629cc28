"""Relational operators that Spark has no single call for, as compositions of DataFrame operations."""

from heddle.operators.joins import asof_join, interval_join, salted_join
from heddle.operators.ordered import latest, sessions, top_k

__all__ = ["asof_join", "interval_join", "latest", "salted_join", "sessions", "top_k"]
