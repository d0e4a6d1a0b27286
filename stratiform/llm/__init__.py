"""Operators for training-data pipelines, on their own: nothing else in the library needs them."""

from stratiform.llm import queries  # noqa: F401
from stratiform.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
