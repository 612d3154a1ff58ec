"""Registered queries over the given tables, each with the SQL it is checked against."""

from lectern.checks import evaluating, modelling, searching, storing, texts  # noqa: F401
from lectern.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
