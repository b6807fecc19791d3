"""Every operator as a named query over the given tables, with the SQL that checks it."""

from __future__ import annotations

from importlib import import_module

_GROUPS = ("ingest", "science", "learning", "monitoring")


def _load() -> None:
    for group in _GROUPS:
        import_module(f"platewise.catalog.{group}")


def all_queries() -> dict:
    from platewise.catalog.base import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from platewise.catalog.base import ORACLES

    _load()
    return dict(ORACLES)
