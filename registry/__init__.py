"""Registered queries over the test tables and their SQL counterparts."""

from registry.core import ORACLES, QUERIES
from registry import (  # noqa: F401  (importing registers)
    q_aggregates,
    q_checks,
    q_evaluation,
    q_features,
    q_forecast,
    q_joins,
    q_reshape,
    q_sources,
)

__all__ = ["ORACLES", "QUERIES"]
