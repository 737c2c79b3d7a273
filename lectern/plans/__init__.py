"""Registered queries; importing this package registers them all."""

from lectern.plans import batches, catalogs, ingestion, language, retrieval, texts  # noqa: F401
from lectern.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
