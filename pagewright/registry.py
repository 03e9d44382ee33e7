"""All queries of the engine's own operators and their SQL."""

from __future__ import annotations

from .plans.queries import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
