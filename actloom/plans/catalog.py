"""All named queries of the engine's own operators."""

from __future__ import annotations

from actloom.plans import act_queries, audit_queries, coverage_queries, item_queries, line_queries  # noqa: F401
from actloom.plans.registry import QUERIES, SQL


def queries():  # noqa: ANN201
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
