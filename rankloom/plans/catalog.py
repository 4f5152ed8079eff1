"""All registered queries and their SQL twins."""

from __future__ import annotations

import importlib

from rankloom.plans.registry import ORACLES, QUERIES

MODULES = ["catalog_tables", "catalog_ranking", "catalog_text", "catalog_metrics", "catalog_learning", "catalog_io"]
for _m in MODULES:
    importlib.import_module(f"rankloom.plans.{_m}")

__all__ = ["ORACLES", "QUERIES"]
