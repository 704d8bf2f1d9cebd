"""Registered queries over the supplied tables, each with its SQL counterpart where there is one."""

from tidemark.plans import arrivals, checks, generators, loads, sales, versions  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
