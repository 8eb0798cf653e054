"""Imports every module that registers queries."""

from graylane.plans import change_queries, join_queries, landing_queries, mart_contract_queries, mart_more_queries, mart_queries, quality_queries, scalar_queries, window_queries
from graylane.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "change_queries", "join_queries", "landing_queries", "mart_contract_queries", "mart_more_queries", "mart_queries", "quality_queries", "scalar_queries", "window_queries"]
