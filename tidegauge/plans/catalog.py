"""Imports every plan module so that its queries are registered."""

from tidegauge.plans import graph, ml, ordered, relational, stream, text  # noqa: F401
from tidegauge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
