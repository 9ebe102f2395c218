"""Registered queries with their SQL twins."""

from __future__ import annotations

from importlib import import_module

from catalog.registry import REGISTRY, Query

MODULES = ("repair", "population", "files", "gold", "models")


def load() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"catalog.{module}")
    return dict(REGISTRY)
