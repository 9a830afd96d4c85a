"""Every query by name, with the SQL that must give the same result."""

from __future__ import annotations

from cartwheel.inventory import aggregates, changes, clicks, fx, marts, quality, reports, sources, tables, windows
from cartwheel.inventory.base import Query

QUERIES: dict[str, Query] = {}
for _module in (sources, changes, clicks, fx, aggregates, windows, marts, tables, quality, reports):
    for _query in _module.QUERIES:
        if _query.name in QUERIES:
            raise ValueError(f"two queries named {_query.name}")
        QUERIES[_query.name] = _query
