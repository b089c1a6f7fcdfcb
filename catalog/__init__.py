"""Registered queries: every operator and job on the given tables, with its SQL equivalent."""

from catalog import aggregating, cleaning, joining, jobs, projecting, rules, sourcing, stacking, windowing
from catalog.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
_MODULES = (cleaning, projecting, rules, joining, aggregating, windowing, stacking, sourcing, jobs)
