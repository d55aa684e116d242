"""All queries of the library by name, and SQL for those that have it."""

from specfold.plans import decompositions, maps, more, relational, shapes, spectral, sweeping  # noqa: F401
from specfold.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
