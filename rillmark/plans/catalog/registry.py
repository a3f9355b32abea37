"""All registered queries."""

from __future__ import annotations

from rillmark.plans.catalog import (
    alert_queries,
    change_queries,
    quality_queries,
    series_queries,
    state_queries,
    stream_queries,
)
from rillmark.plans.catalog.inputs import Query


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (change_queries, quality_queries, series_queries, alert_queries, stream_queries, state_queries):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name!r} is registered twice")
            found[name] = query
    return found
