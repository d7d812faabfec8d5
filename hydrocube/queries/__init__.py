"""The engine's registered queries: one or more for each operator, with independent SQL."""

from . import aggregates, plans, scalar  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
