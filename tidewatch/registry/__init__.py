"""Registered queries over the benchmark tables, each with its SQL where it has one."""

from tidewatch.registry import batch, load, star, stream  # noqa: F401  (they register on import)
from tidewatch.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
