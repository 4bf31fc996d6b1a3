"""Queries over the test tables, each with its SQL counterpart where SQL can express it."""

from medlake.queries.catalog import ORACLES, QUERIES
from medlake.queries import lake, quality, records, reports, search, stored  # noqa: F401  (register)

__all__ = ["ORACLES", "QUERIES"]
