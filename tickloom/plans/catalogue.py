"""All registered queries of the market-data operators."""

from tickloom.plans import q_aggs, q_books, q_filters, q_gates, q_joins, q_normalize, q_quality, q_roles, q_tables, q_windows  # noqa: F401
from tickloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
