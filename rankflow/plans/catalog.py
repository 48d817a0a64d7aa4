"""The driver-table query catalogue: every registered operator query and its
DuckDB oracle text (absent for rows-only checks)."""

from __future__ import annotations

from rankflow.plans import q_functions, q_jobs, q_ml, q_relational, q_sources  # noqa: F401  (registration)
from rankflow.plans.registry import REGISTRY, Builder


def queries() -> dict[str, Builder]:
    return {name: q.build for name, q in sorted(REGISTRY.items())}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in sorted(REGISTRY.items()) if q.sql}
