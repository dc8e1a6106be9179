"""Registered queries over the shared parquet tables, each with its independent SQL."""

from . import aggregates, columns, joins, lifecycle, pipelines, windows  # noqa: F401  (they register)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
