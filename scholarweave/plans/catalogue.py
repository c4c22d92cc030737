"""All registered queries."""

from scholarweave.plans import (  # noqa: F401
    count_queries, graph_queries, io_queries, match_queries, record_queries, text_queries,
)
from scholarweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
