"""Column-level functions: cleaning, safe scalar arithmetic, moments, row statistics."""

from . import clean, moments, rowstats, scalar  # noqa: F401
