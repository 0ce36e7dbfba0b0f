"""All named queries of this package except those for training data."""

from __future__ import annotations

from . import audit, base, dedup, delivery, documents, lifecycle, operations  # noqa: F401


def queries() -> dict[str, base.Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
