from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

@pytest.fixture
def documents(spark):
    """Makes documents from (doc_id, text[, lang[, source]])."""
    def make(*rows):
        filled = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(filled, SCHEMA)

    return make


@pytest.fixture
def odd_documents(documents):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids."""
    long_text = " ".join(f"word{i % 700}" for i in range(30_000))
    return documents(
        (1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, long_text, "en", "a"), (5, "x" * 50_000, "en", "a"),
        (6, "same row here", "en", "a"), (6, "same row here", "en", "a"), (7, "one id", "en", "a"), (7, "two texts", "de", "b"),
        (None, "no id at all", "fr", None), (8, "ﬁ ① 漢字   é́ 𝒳", None, "c"),
    )


@pytest.fixture
def clashing():
    """Adds columns with the names that operators use inside and return."""
    from pyspark.sql import functions as F

    names = [
        "node", "label", "digest", "registers", "n_shingles", "component_id", "kept", "score", "lang_pred", "rejected", "spans",
        "word", "ids", "at", "site", "row", "lines", "boilerplate", "content", "n_tokens", "a.b", "odd`name", "host", "item_id",
    ]
    return lambda df: df.withColumns({n: F.lit("clash") for n in names})
