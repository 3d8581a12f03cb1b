"""All registered queries by name."""

from __future__ import annotations

from . import commits, decode, filters, layout, merges, ordered, published, readers, relations, shapes

QUERIES = {
    name: query
    for module in (decode, filters, merges, relations, ordered, readers, published, layout, commits, shapes)
    for name, query in module.QUERIES.items()
}
