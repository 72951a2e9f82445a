"""Queries over the driver's tables, each with the SQL that states its result where SQL can."""

from tabloom.catalog.base import ORACLES, QUERIES
from tabloom.catalog import fitting, learning, profiling, relational, scalars, sources, statistics  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
