"""Queries on the shared test tables and their SQL equivalents."""

from bindings import answers, files, jobs, matching, stores, tables, texts, topics, votes  # noqa: F401
from bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
