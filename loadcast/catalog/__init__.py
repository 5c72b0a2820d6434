"""Registered queries over the given tables, with check SQL where SQL can express them."""

from loadcast.catalog import job_queries, scalar_queries, series_queries, shape_queries  # noqa: F401
from loadcast.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
