"""All queries by name."""

from __future__ import annotations

import importlib

MODULES = ["profiling", "ingestion", "dictionary", "harmonization", "review", "lake"]


def all_queries() -> dict:
    out: dict = {}
    for name in MODULES:
        found = importlib.import_module(f"lakewright.queries.{name}").QUERIES
        clash = out.keys() & found.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        out.update(found)
    return out
