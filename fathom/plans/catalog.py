"""All registered queries with their oracle SQL."""

from __future__ import annotations

from importlib import import_module

from fathom.plans.adapt import ORACLE_SQL, QUERIES

MODULES = ("q_clean", "q_aggregate", "q_series", "q_sets", "q_graph", "q_forecast", "q_rows", "q_model", "q_markets", "q_sources")
for _name in MODULES:
    import_module(f"fathom.plans.{_name}")

__all__ = ["ORACLE_SQL", "QUERIES"]
