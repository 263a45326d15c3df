"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

import importlib

MODULES = [
    "kiln.plans.classify",
    "kiln.plans.features",
    "kiln.plans.corpus",
    "kiln.plans.ingest",
    "kiln.plans.markup",
    "kiln.plans.mlpipes",
]


def queries() -> dict:
    out = {}
    for m in MODULES:
        out.update(importlib.import_module(m).QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in MODULES:
        out.update(getattr(importlib.import_module(m), "ORACLE", {}))
    return out
