"""All named queries of the library with their oracles."""

from __future__ import annotations

from tablesift.plans import archive, grounding, layout, quality  # noqa: F401  importing registers their queries
from tablesift.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
