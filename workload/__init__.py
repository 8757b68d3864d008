"""Queries on the given tables, one module per part of the system."""

from workload import catalogue, contents, files, filters, jobs, profiles, registry, sheets, similarity, traffic  # noqa: F401
from workload.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
