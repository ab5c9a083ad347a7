"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, filter_audit, langid, license_scan, metric_join, minhash, packing, periodic_runs, quality, substring, token_counts, topk_bsi, toxicity

_MODULES = (topk_bsi, toxicity, license_scan, bpe, minhash, metric_join, token_counts, substring, langid, packing, filter_audit, periodic_runs, quality)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
