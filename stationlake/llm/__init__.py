"""Operators for preparing training text at scale. Nothing else in the library imports this folder."""

from __future__ import annotations


def all_queries():
    from stationlake.llm import queries

    return dict(queries.QUERIES)


def all_sql() -> dict[str, str]:
    from stationlake.llm import queries

    return dict(queries.SQL)
