"""Registered queries, each beside the SQL that says what it must give."""

from terralode.queries import cleaning, files, flattening, flows, models, monitoring, routing  # noqa: F401
from terralode.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
