"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scalar", "rules", "stores", "streams")


def load_all() -> None:
    """Import every query module; importing registers its queries."""
    for name in MODULES:
        import_module(f"tillstream.queries.{name}")
