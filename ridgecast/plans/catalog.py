"""Every registered query with its oracle."""

from __future__ import annotations

from ridgecast.plans import joins, relational, surfaces  # noqa: F401  (joins and surfaces register their queries)


def queries() -> dict:
    return dict(relational.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(relational.ORACLES)
