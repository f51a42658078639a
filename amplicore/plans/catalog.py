"""All registered queries of the matrix engine."""

from __future__ import annotations

from amplicore.plans import ecology_queries, kernel_queries, matrix_queries, read_queries, taxonomy_queries  # noqa: F401  they register their queries
from amplicore.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
