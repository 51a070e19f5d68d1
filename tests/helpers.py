"""Shared by the test modules; named so that no other folder's conftest hides it."""

from __future__ import annotations


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
