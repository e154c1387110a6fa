"""Queries over the given test tables, each with the SQL it is checked against."""

from folioloom.registry import ingest, storage, chunking, vectors, fulltext  # noqa: F401  (they register themselves)
from folioloom.registry.book import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
