"""Registered queries over the driver tables, each next to its SQL counterpart."""
from __future__ import annotations

from assayframe.catalog import (
    aggregates, coverage, entities, expressions, files, filters, quality, repair, stress,
)
from assayframe.catalog.base import Query

MODULES = (
    quality, expressions, filters, aggregates, entities, coverage, repair, stress, files,
)


def catalog() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in MODULES:
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = query
    return found
