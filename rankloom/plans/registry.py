"""Where queries and their SQL twins are registered."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_VIEW = re.compile(r"\bv_[a-z_]+\b")


def with_views(sql: str) -> str:
    """Put the fixture views a statement names, and those they name, before it."""
    from rankloom.plans.fixtures import VIEW_SQL

    needed: set[str] = set()
    todo = [v for v in _VIEW.findall(sql) if v in VIEW_SQL]
    while todo:
        v = todo.pop()
        if v not in needed:
            needed.add(v)
            todo += [x for x in _VIEW.findall(VIEW_SQL[v]) if x in VIEW_SQL]
    sql = sql.strip()
    if not needed:
        return sql
    head = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in VIEW_SQL if v in needed)
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head},\n{sql[15:]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {head},\n{sql[5:]}"
    return f"WITH {head}\n{sql}"


def query(name: str, sql: str | None = None):
    """Register a query under ``<id>_<slug>`` with its SQL twin, if it has one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add
