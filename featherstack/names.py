"""Feature-name builder: one flat, lower-case name per (prefix, column, statistic)."""

from __future__ import annotations


def feature_name(prefix: str | None, col: str, fn: str | None = None) -> str:
    parts = [p for p in (prefix, col, fn) if p]
    return "_".join(parts).lower()
