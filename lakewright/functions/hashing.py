"""Deterministic position-weighted hashes and pseudonyms for de-identification."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The hash modulus, the separator between salt and value, the default
# range of the hash and the letters pseudonyms are made of.
MODULUS = 1000003
SEPARATOR = "||"
HASH_RANGE = 2147483647
LETTERS = string.ascii_lowercase + string.ascii_uppercase


def weighted_hash(value: Column, salt: str, size: int = HASH_RANGE) -> Column:
    """Sum of code point times position (each term reduced by the modulus), modulo ``size``.
    NULL hashes like the text NA."""
    text = F.concat(F.lit(salt + SEPARATOR), F.coalesce(value, F.lit("NA")))
    terms = F.transform(
        F.split(text, ""), lambda ch, i: (F.ascii(ch) * (i + F.lit(1))) % F.lit(MODULUS)
    )
    total = F.aggregate(terms, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return total % F.lit(size)


def weighted_hash_of(text: str, salt: str, size: int = HASH_RANGE) -> int:
    """``weighted_hash`` of one known text, for offsets fixed before the job starts."""
    whole = salt + SEPARATOR + text
    return sum(ord(ch) * i % MODULUS for i, ch in enumerate(whole, start=1)) % size


def pseudonym(value: Column, salt: str, length: int = 10) -> Column:
    """A ``length``-letter name determined by the value; NULL stays NULL."""
    size = len(LETTERS)
    start = F.struct(
        (weighted_hash(value, salt) + 1).alias("state"), F.lit("").alias("letters")
    )
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(length)),
        start,
        lambda acc, k: F.struct(
            (F.floor(acc["state"] / size) + k).cast("bigint").alias("state"),
            F.concat(
                acc["letters"],
                F.substring(F.lit(LETTERS), (acc["state"] % size + 1).cast("int"), F.lit(1)),
            ).alias("letters"),
        ),
        lambda acc: acc["letters"],
    )
    return F.when(value.isNotNull(), walked)
