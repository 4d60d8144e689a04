"""Queries on the given tables, one per operator, each with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from .base import ORACLES, QUERIES

MODULES = ["formulas", "rasters", "zips", "hourly", "regions", "written"]


def _load() -> None:
    for m in MODULES:
        import_module(f"{__name__}.{m}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return {name: text() for name, text in ORACLES.items()}
