"""All registered queries."""

from harness import bi_queries, flight_queries, lake_queries, landed_queries, model_queries, state_queries  # noqa: F401
from harness.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
