"""Registered queries over the supplied data, each with its SQL twin where one exists."""

from __future__ import annotations

MODULES = (
    "names", "ledger", "volumes", "filters", "scalars", "grids", "detection", "rasters", "sources", "streams",
)


def load_all() -> None:
    """Import every module that registers queries."""
    from importlib import import_module

    for name in MODULES:
        import_module(f"workload.{name}")
