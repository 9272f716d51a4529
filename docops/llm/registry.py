"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from docops.llm import centroids, divergence, licenses, linedup, mixing, packing, quality
from docops.llm import revisits, secrets, simhash, sources, substrings, topk

MODULES = (
    *(packing, mixing, revisits, topk, quality, simhash, linedup, divergence, substrings, secrets),
    *(licenses, centroids, sources),
)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
