"""Named queries over the driver's tables: each has a DataFrame plan and, where SQL can say it, the
equivalent ANSI SQL."""

from __future__ import annotations

from importlib import import_module

AREAS = [
    "clean", "select", "reshape", "join", "aggregate", "window", "session", "catalog", "stream",
    "long", "store",
]


def load():
    """The registry with the queries of every area."""
    for area in AREAS:
        import_module(f".{area}_queries", __name__)
    return import_module(".registry", __name__)
