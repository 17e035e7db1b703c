"""Checked queries: each runs operators over the given tables and has its DuckDB counterpart."""

from catalog.registry import ORACLES, QUERIES
from catalog import composites, files, joins, movements, scalars  # noqa: F401  (register)

__all__ = ["ORACLES", "QUERIES"]
