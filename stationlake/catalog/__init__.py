"""Queries registered with the driver: adapters over the given tables, and their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

from stationlake.catalog.registry import QUERIES, SQL, Query

_MODULES = ("cleaning", "metrics", "quality", "files", "manifests", "tables")


def _load() -> None:
    for name in _MODULES:
        import_module(f"{__name__}.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
