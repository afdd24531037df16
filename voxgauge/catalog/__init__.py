"""The registered queries."""

from voxgauge.catalog import ingest, retrieval, scores, texts  # noqa: F401
from voxgauge.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
