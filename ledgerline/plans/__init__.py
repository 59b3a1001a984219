"""Named queries, grouped as in the blueprint."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "reports",
    "joins",
    "aggregates",
    "ranking",
    "cleaning",
    "scalars",
    "series",
    "text",
    "preparation",
    "evaluation",
    "models",
    "files",
    "streams",
)


def load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
