"""All queries of the library by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .queries import deliveries, documents, notices, pages, runs, stories, tables

_MODULES = (pages, documents, tables, notices, stories, deliveries, runs)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
FLAGSHIP = pages.page_selection
