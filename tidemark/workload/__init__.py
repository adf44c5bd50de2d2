"""Queries over the given tables: importing this package fills the registry."""

from tidemark.workload import aggregates, checks, explained, history, joins, layouts, ordered, projections, streams  # noqa: F401
from tidemark.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
