"""Registered queries: each runs on a folder of the test tables."""

from __future__ import annotations

from pasarlens.registry import (
    aggregates,
    cleaning,
    features,
    joins,
    learning,
    metrics,
    serving,
    sources,
    tables,
    windows,
)
from pasarlens.registry.base import Query


def all_queries() -> list[Query]:
    found: list[Query] = []
    for module in (
        tables,
        sources,
        cleaning,
        features,
        windows,
        aggregates,
        joins,
        metrics,
        serving,
        learning,
    ):
        found += module.QUERIES
    names = [q.name for q in found]
    assert len(names) == len(set(names)), "query names must be unique"
    return found
