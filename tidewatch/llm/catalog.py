"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import importlib

import corpus_pipeline

MODULES = ["mixing", "credentials", "article", "urls", "pii", "rollups", "exact", "contamination", "langid", "probminhash",
           "ledger", "merkle", "negatives"]
_LOADED = [importlib.import_module(f"{__package__}.{m}") for m in MODULES]

QUERIES = {name: fn for m in _LOADED for name, fn in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}
ORACLES = {name: sql for m in _LOADED for name, sql in m.ORACLES.items()}
