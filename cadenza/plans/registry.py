"""Registry of named queries ``(spark, sf_dir) -> DataFrame`` and their DuckDB oracle SQL.

Keys are ``<survey id>_<name>`` in lower case so each points back to its
SURVEY §2 row.
"""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
