"""Helpers shared by the test modules."""

from __future__ import annotations


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(str(v) for v in r))
