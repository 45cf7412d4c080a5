"""All queries of this package by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from lakewright.llm import contamination, language, lines, manifest, neardup, pieces, quality, repair, repeats, secrets, tokens, toxicity, urls

QUERIES = {}
for _module in (urls, tokens, language, toxicity, lines, pieces, quality, neardup, secrets, contamination, repair, repeats, manifest):
    QUERIES.update(_module.QUERIES)
