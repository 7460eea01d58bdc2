"""Registered queries over the supplied tables, and SQL stating the same results."""

from rankflow.catalog.queries import QUERIES
from rankflow.catalog.sql import ORACLES

__all__ = ["ORACLES", "QUERIES"]
