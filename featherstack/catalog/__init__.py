"""Registered queries (one per operator of the inventory) and their DuckDB oracles."""

from . import features_q, joins_agg, models_q, prepare, slice, sources_clean, window_scalar  # noqa: F401  (registration side effects)
from .common import KINDS, ORACLES, PLANS, QUERIES  # noqa: F401
