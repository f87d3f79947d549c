"""The registered queries."""

from __future__ import annotations

from importlib import import_module
from types import ModuleType

MODULES = ["q_text", "q_tables", "q_serve", "q_pages"]


def load() -> ModuleType:
    """Register every query and return the registry."""
    for name in MODULES:
        import_module(f"postloom.catalog.{name}")
    return import_module("postloom.catalog.registry")
