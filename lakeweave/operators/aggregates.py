"""Aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column


def any_not_null(*cols: Column) -> Column:
    """True when at least one of ``cols`` is not NULL."""
    out = cols[0].isNotNull()
    for c in cols[1:]:
        out = out | c.isNotNull()
    return out
