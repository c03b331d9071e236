"""One function per query, mapping the given tables onto the operators."""

from __future__ import annotations

from importlib import import_module

AREAS = ("standard", "gold", "audits", "texts", "matching", "history", "stores")


def all_queries() -> dict:
    """``name -> (run, equivalent SQL or None)``."""
    out: dict = {}
    for area in AREAS:
        out.update(import_module(f"{__name__}.{area}").QUERIES)
    return out
