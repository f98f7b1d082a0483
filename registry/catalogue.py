"""All registered queries."""

from __future__ import annotations

from registry import evaluation, files, profiles, recommenders, relational, scalar  # noqa: F401
from registry.base import REGISTRY


def queries() -> dict:
    return dict(REGISTRY.queries)


def oracle_sql() -> dict[str, str]:
    made = {name: sql() if callable(sql) else sql for name, sql in REGISTRY.sql.items()}
    return {name: sql for name, sql in made.items() if sql is not None}
