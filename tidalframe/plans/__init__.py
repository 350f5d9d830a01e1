"""Registered queries. Importing a module of this package registers its queries."""

from __future__ import annotations

from importlib import import_module

from tidalframe.plans.registry import ORACLES, QUERIES

MODULES = (
    "flagship",
    "sources",
    "shape",
    "filters",
    "joins",
    "aggregates",
    "windows",
    "calendar",
    "scalars",
    "features",
    "customers",
    "forecasts",
    "metrics",
    "learners",
    "series",
    "tuning",
    "closed",
    "search",
    "streams",
    "studies",
)


def collect():
    for name in MODULES:
        import_module(f"tidalframe.plans.{name}")
    return QUERIES, ORACLES
