"""Registered queries over the shared test tables and their SQL oracles."""

from clickscope.plans.catalogue import batch_queries, all_queries, Params
from clickscope.plans.oracle import oracle_sql

__all__ = ["batch_queries", "all_queries", "Params", "oracle_sql"]
