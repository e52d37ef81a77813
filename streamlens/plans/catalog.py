"""All registered queries. Importing a module below registers what it defines."""

from __future__ import annotations

from streamlens.plans import basic, metrics, relations, risk, twins  # noqa: F401
from streamlens.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
