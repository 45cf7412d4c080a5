"""Key upserts expressed as joins: the result is the new content of the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    found = duplicate_keys(df, keys).take(1)
    if found:
        key = "|".join(str(found[0][k]) for k in keys)
        raise ValueError(f"{what}: duplicate key {key}")


def upserted(
    current: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    keep: tuple[str, ...] = (),
    rules: dict[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """``current`` with the rows of ``incoming`` inserted or, where the key exists, updated.

    An updated row takes every column of ``incoming`` but those in ``keep``; ``rules`` gives
    columns a rule of their own from (old value, new value). Columns that only ``current``
    has are kept.
    """
    rules = rules or {}
    old, new = current.alias("old"), incoming.alias("new")
    condition = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    matched = old.withColumn("in_old", F.lit(True)).alias("old").join(
        new.withColumn("in_new", F.lit(True)).alias("new"), condition, "full_outer"
    )
    in_old, in_new = F.col("in_old").isNotNull(), F.col("in_new").isNotNull()
    out = []
    for c in current.columns:
        before = F.col(f"old.{c}")
        if c not in incoming.columns:
            out.append(before.alias(c))
            continue
        after = F.col(f"new.{c}")
        if c in keys:
            value = F.coalesce(after, before)
        elif c in rules:
            value = F.when(in_old & in_new, rules[c](before, after)).when(in_new, after) \
                .otherwise(before)
        elif c in keep:
            value = F.when(in_old, before).otherwise(after)
        else:
            value = F.when(in_new, after).otherwise(before)
        out.append(value.alias(c))
    return matched.select(*out)


def inserted_if_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key ``current`` does not hold: what an append would add."""
    return incoming.join(held_keys(current, keys), same_key(keys), "left_anti")


def held_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of a table under names of their own, for a join by ``same_key``."""
    return df.select(*[F.col(k).alias(f"held_{k}") for k in keys])


def same_key(keys: list[str]) -> list[Column]:
    """NULL keys equal each other, as in ``upserted``."""
    return [F.col(k).eqNullSafe(F.col(f"held_{k}")) for k in keys]
