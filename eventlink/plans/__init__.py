"""Registered queries (one per operator / product of SURVEY §2) and oracles."""

from . import q_eligible, q_events, q_features, q_model, q_reports, q_tables  # noqa: F401  (registers)
from .registry import QUERIES  # noqa: F401
