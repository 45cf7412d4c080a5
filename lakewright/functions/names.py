"""Canonical column and table names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit notes that keep their meaning when brackets are dropped.
UNIT_NOTES = [
    (r"\(y/n\)", "yn"),
    (r"\(minutes\)", "minutes"),
    (r"\(min\)", "min"),
    (r"\(cm\)", "cm"),
    (r"\(kg\)", "kg"),
]


def normalize_name(name: str) -> str:
    """Lower case, unit notes unwrapped, every other run of symbols one underscore."""
    out = name.lower().strip()
    for pattern, plain in UNIT_NOTES:
        out = re.sub(pattern, plain, out)
    return re.sub(r"[^a-z0-9]+", "_", out).strip("_")


def normalized(c: Column) -> Column:
    """``normalize_name`` as a column expression, for names held in tables."""
    out = F.lower(F.trim(c))
    for pattern, plain in UNIT_NOTES:
        out = F.regexp_replace(out, pattern, plain)
    return F.btrim(F.regexp_replace(out, r"[^a-z0-9]+", "_"), F.lit("_"))


def key_name(c: Column) -> Column:
    """Lower-cased and trimmed, the form dictionary keys are compared in."""
    from lakewright.functions.text import trim_blanks

    return F.lower(trim_blanks(c))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns; of columns that normalize alike the first one is kept."""
    names = [normalize_name(c) for c in df.columns]
    unique = [f"c{i}" for i in range(len(names))]
    kept = {}
    for position, name in enumerate(names):
        kept.setdefault(name, position)
    return df.toDF(*unique).select(*[F.col(unique[i]).alias(n) for n, i in kept.items()])
