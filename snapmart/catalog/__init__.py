"""Registered queries over the given tables, each with the SQL text it must agree with."""

from snapmart.catalog import checks, history, landing, market, records, relational, scalars  # noqa: F401
from snapmart.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
