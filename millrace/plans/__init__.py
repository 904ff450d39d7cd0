"""Registered queries, each over the whole of the given tables, with SQL oracles where SQL can say it."""

from millrace.plans import (  # noqa: F401  (importing registers the queries)
    basics, cell_queries, files, grouping, joining, live, payloads, streams, timed,
)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
