"""Registered queries on the driver tables and their DuckDB oracle SQL.

Each module exports ``QUERIES`` (name → ``f(spark, sf_dir) -> DataFrame``)
and ``ORACLE`` (name → SQL over the pre-registered driver views). Queries
that are not expressible in SQL have no oracle entry.
"""

from __future__ import annotations

from importlib import import_module

_MODULES = ["models", "core", "io", "layers", "clinical", "maintained", "codemaps", "history", "landing", "constraints", "typed"]


def _load():
    queries, oracle = {}, {}
    for name in _MODULES:
        mod = import_module(f"{__name__}.{name}")
        dup = set(queries) & set(mod.QUERIES)
        if dup:
            raise RuntimeError(f"duplicate query names {sorted(dup)}")
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _load()[0]


def all_oracles():
    return _load()[1]
