"""The operators run on the given tables, each next to its SQL twin."""

from lynxrisk.queries import silver_queries, feature_queries, register_queries, risk_queries  # noqa: F401, I001
from lynxrisk.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
