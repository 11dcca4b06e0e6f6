"""Registered queries of the engine, each with its SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
