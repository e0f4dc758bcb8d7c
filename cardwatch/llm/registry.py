"""Queries of this package and their SQL, kept apart from those of the library."""

from __future__ import annotations

from cardwatch.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register
