"""All registered queries and their SQL twins."""

from __future__ import annotations

from urbana.queries import cleaning, domain, functions, grouping, joining, loading, sources, streams, windows  # noqa: F401
from urbana.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
