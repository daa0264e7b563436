"""Registered queries, grouped by area."""

import importlib
import pkgutil

from newsgrid.plans.registry import ORACLE, QUERIES

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.endswith("_queries")):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLE", "QUERIES"]
