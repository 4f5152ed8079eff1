"""Queries of the subpackage and their SQL twins."""

from __future__ import annotations

import importlib

from rankloom.llm.common import ORACLES, QUERIES

MODULES = [
    "personal_data",
    "katz",
    "quality_trees",
    "warc",
    "near_duplicates",
    "language_spans",
    "licence_dice",
    "packing",
    "winnowing",
    "secret_forest",
    "chunk_recipes",
    "phrases",
    "spelling",
]
for _m in MODULES:
    importlib.import_module(f"rankloom.llm.{_m}")

__all__ = ["ORACLES", "QUERIES"]
