"""Every query with, where SQL can say it, the equivalent SQL text."""

from tidemark.queries import documents, federation, relational, reviews, temporal
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "documents", "federation", "relational", "reviews", "temporal"]
