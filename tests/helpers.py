"""Names that the tests share (not in ``conftest``, whose module name every test folder has)."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison helper)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
