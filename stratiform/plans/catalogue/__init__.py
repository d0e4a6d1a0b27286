"""Registered queries with the SQL that gives the same rows."""

from stratiform.plans.catalogue import bronze, control, gold, protection, rules, silver, streams  # noqa: F401
from stratiform.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
